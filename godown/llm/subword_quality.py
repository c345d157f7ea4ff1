"""Quality classifier on supervised subword embeddings (operator 2).

Features are hashed: each word of a text, its character n-grams and word
bigrams that repeat a word own a bucket of a fixed table of vectors.  A document is the average of its
feature vectors, a linear layer and softmax give the class, and mini-batch
stochastic gradient descent in numpy trains vectors and layer together.
The model has a fixed size, so it travels as a broadcast.  The output is
linear in the average, so in scoring a distinct word is reduced to one
number and a count, once per task.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.common import out_batch, slices, written

BUCKETS = 1 << 16
DIM = 8
NGRAMS = (3,)
EPOCHS = 4
#: AdaGrad step: each vector's step shrinks with the gradients it has seen.
RATE = 0.1
BATCH = 32
SEED = 7
#: Labelled documents that are learned from, per class: the first in order of a hash of their id.
TRAIN_PER_CLASS = 1000
TABLE_ROWS = 300_000
SAME = b" "


def features(word: bytes) -> list[int]:
    """Buckets of a word and of the character n-grams of the marked word."""
    if word == SAME:
        return [zlib.crc32(b"same") % BUCKETS]
    marked = "<" + word.decode("utf-8", "replace") + ">"
    grams = [marked[i:i + n].encode() for n in NGRAMS for i in range(len(marked) - n + 1)]
    return [zlib.crc32(b"w" + word) % BUCKETS, *(zlib.crc32(g) % BUCKETS for g in grams)]


def tokens(text) -> list[bytes]:
    """The words of a text, and a mark for each word bigram that repeats its word (a back-reference, alike for all words)."""
    words = (text or "").encode().split()
    return words + [SAME] * sum(map(eq, words, words[1:]))


def bags(texts) -> tuple[list[bytes], list[tuple[np.ndarray, np.ndarray]]]:
    """The distinct words of all texts; per text word numbers and counts."""
    number: dict[bytes, int] = {}
    out = []
    for t in texts:
        ids = [number.setdefault(w, len(number)) for w in tokens(t)]
        out.append(np.unique(np.array(ids, dtype=np.int64), return_counts=True))
    return list(number), out


def fit(texts, labels, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED):
    """(vectors float32, layer, bias) for labels 0 and 1; classes weigh the same in sum."""
    rng = np.random.default_rng(seed)
    words, docs = bags(texts)
    labels = np.asarray(labels, dtype=np.int64)
    feats = [features(w) for w in words]
    size = np.array([len(f) for f in feats], dtype=np.int64)
    start = np.cumsum(size) - size
    flat = np.array([x for f in feats for x in f], dtype=np.int64)
    vec = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    weight = np.array([0.5 / max(1, (labels == c).sum()) for c in (0, 1)]) * len(labels)
    keep = np.array([i for i, (u, _) in enumerate(docs) if len(u)], dtype=np.int64)
    seen = np.full(BUCKETS, 1e-8, dtype=np.float32)
    seen_layer, seen_bias = np.full((DIM, 2), 1e-8, dtype=np.float32), np.full(2, 1e-8, dtype=np.float32)
    for _ in range(epochs):
        order = rng.permutation(keep)
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            used = np.unique(np.concatenate([docs[i][0] for i in pick]))
            share = np.zeros((len(pick), len(used)), dtype=np.float32)      # word counts over the text's features
            for r, i in enumerate(pick):
                u, c = docs[i]
                share[r, np.searchsorted(used, u)] = c / (c * size[u]).sum()
            cut = np.cumsum(size[used]) - size[used]
            f = flat[np.arange(size[used].sum()) + np.repeat(start[used] - cut, size[used])]
            hidden = share @ np.add.reduceat(vec[f], cut, axis=0)
            z = hidden @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1.0
            g = (p * weight[labels[pick]][:, None] / len(pick)).astype(np.float32)
            back = np.repeat(share.T @ (g @ layer.T), size[used], axis=0)
            by = np.argsort(f, kind="stable")
            at = np.flatnonzero(np.diff(f[by], prepend=-1))
            touched, grad = f[by][at], np.add.reduceat(back[by], at, axis=0)
            seen[touched] += (grad ** 2).mean(axis=1)
            vec[touched] -= rate * grad / np.sqrt(seen[touched])[:, None]
            g_layer, g_bias = hidden.T @ g, g.sum(axis=0)
            seen_layer += g_layer ** 2
            seen_bias += g_bias ** 2
            layer -= rate * g_layer / np.sqrt(seen_layer)
            bias -= rate * g_bias / np.sqrt(seen_bias)
    return vec, layer, bias


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = TRAIN_PER_CLASS,
          id_col: str = "doc_id", text_col: str = "text"):
    """Fit on at most ``per_class`` whole documents of each class; None if a class has none.

    ``labels`` (id, label 0 / 1) holds the rows to learn from.  The sample is
    bounded, so one task fits it; the model comes back as written rows.
    """
    marked = (labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), F.lit("subword"))))
    ids = None
    for y in (0, 1):
        part = marked.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    ids = written(ids.select("doc_id", "y").distinct(), "quality_ids")
    sample = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
              .join(F.broadcast(ids), "doc_id").select("y", "doc_id", "text"))     # at most 2 * per_class rows

    def run(table):
        table = table.sort_by([("doc_id", "ascending"), ("y", "ascending")])
        y = table.column("y").to_numpy()
        if len(set(y.tolist())) < 2:
            return pa.table({"part": pa.array([], pa.string()), "data": pa.array([], pa.binary())})
        model = fit(table.column("text").to_pylist(), y)
        return pa.table({"part": pa.array(["vec", "layer", "bias"]), "data": pa.array([m.tobytes() for m in model], pa.binary())})

    rows = sample.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(run, "part string, data binary").collect()
    if not rows:
        return None
    raw = {r["part"]: np.frombuffer(r["data"], dtype=np.float32) for r in rows}
    return raw["vec"].reshape(BUCKETS, DIM), raw["layer"].reshape(DIM, 2), raw["bias"]


def scorer(model):
    """Texts -> scores, as a function for tasks; ``model`` as (a weight per bucket, bias)."""
    weights, bias = model
    table: dict[bytes, tuple[float, int]] = {}

    def run(texts) -> list[float]:
        out = []
        for text in texts:
            words = tokens(text)
            if len(table) > TABLE_ROWS:
                table.clear()
            got = []
            for w in words:
                s = table.get(w)
                if s is None:
                    f = features(w)
                    s = (float(weights[f].sum()), len(f))
                    table[w] = s
                got.append(s)
            n = sum([s[1] for s in got])
            z = bias + (sum([s[0] for s in got]) / n if n else 0.0)
            out.append(float(1.0 / (1.0 + np.exp(-max(-50.0, min(50.0, z))))))
        return out

    return run


def reduced(model) -> tuple[np.ndarray, float]:
    """The model as the difference of its two outputs: a weight per bucket, and the bias."""
    if model is None:
        return np.zeros(BUCKETS, dtype=np.float32), 0.0
    vec, layer, b = model
    return vec @ (layer[:, 1] - layer[:, 0]), float(b[1] - b[0])


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: probability of class 1 of every whole text.

    Null and empty text has no features: its score is that of the bias
    alone.  Without a model (a class without rows) every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(reduced(model))

    def run(batches):
        scores = scorer(shared.value)
        for b in slices(batches):
            yield out_batch(["doc_id", "score"], [b.column(0), pa.array(scores(b.column(1).to_pylist()), pa.float64())])

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")


def keep(docs: DataFrame, model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(reduced(model))

    def run(batches):
        scores = scorer(shared.value)
        for b in slices(batches, text_col):
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            yield b.filter(pa.array([s >= least for s in scores(texts)]))

    return docs.mapInArrow(run, docs.schema)
