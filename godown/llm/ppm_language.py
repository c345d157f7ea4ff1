"""Language identification by prediction by partial matching (operator 3).

Per language a byte context tree: how often each byte followed each context
of up to ``ORDER`` bytes inside a marked word (the word, a blank in front
and behind).  The tree is frozen; a byte costs -log2 of its probability in
the longest known context, with escape probability distinct / (total +
distinct) (method C) down to order 0 and a uniform order -1.  A document's
code length is the sum over its words, exactly; contexts start afresh at
white space, so a distinct word is coded once per task.  The language with
the shortest code wins; the score is its share of 2^-length.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.common import out_batch, slices

ORDER = 4
#: Documents per language that the trees are counted from: the first in order of a hash of their id.
TRAIN_DOCS = 1500
TABLE_ROWS = 300_000
#: Longer words are coded, but not remembered.
LONG_WORD = 64


def contexts(word: bytes, order: int):
    """(context, byte) for each byte of the marked word, at the longest context."""
    marked = b" " + word + b" "
    for i in range(1, len(marked)):
        yield marked[max(0, i - order):i], marked[i]


def grow(words: Counter, order: int) -> dict[bytes, dict[int, int]]:
    """The context tree: context -> byte -> count, for all orders."""
    tree: dict[bytes, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    for word, n in words.items():
        for ctx, byte in contexts(word, order):
            for k in range(len(ctx) + 1):
                tree[ctx[k:]][byte] += n
    return {c: dict(d) for c, d in tree.items()}


def cost(tree: dict, ctx: bytes, byte: int) -> float:
    """Bits for ``byte`` after ``ctx``: escapes from the longest known context downwards."""
    bits = 0.0
    for k in range(len(ctx) + 1):
        seen = tree.get(ctx[k:])
        if not seen:
            continue
        total = sum(seen.values()) + len(seen)
        n = seen.get(byte)
        if n:
            return bits - math.log2(n / total)
        bits -= math.log2(len(seen) / total)
    return bits + 8.0


def frozen(tree: dict) -> tuple[dict[bytes, float], dict[bytes, float]]:
    """(context + byte -> bits, context -> bits of an escape) of a grown tree."""
    known, escape = {}, {}
    for ctx, seen in tree.items():
        total = sum(seen.values()) + len(seen)
        escape[ctx] = -math.log2(len(seen) / total)
        for byte, n in seen.items():
            known[ctx + bytes([byte])] = -math.log2(n / total)
    return known, escape


def word_bits(word: bytes, known: dict, escape: dict, order: int) -> float:
    marked = b" " + word + b" "
    bits = 0.0
    for i in range(1, len(marked)):
        a = max(0, i - order)
        while True:
            got = known.get(marked[a:i + 1])
            if got is not None:
                bits += got
                break
            bits += escape.get(marked[a:i], 0.0)
            if a == i:
                bits += 8.0
                break
            a += 1
    return bits


def packed(ctx: bytes) -> int:
    """Up to seven bytes and their number as one integer."""
    return int.from_bytes(ctx, "big") | len(ctx) << 56


class TreeTable:
    """The frozen trees of all languages as sorted arrays; codes many words at once."""

    def __init__(self, order: int, n: int, known, known_bits, escape, escape_bits):
        self.order, self.n = order, n
        self.known, self.known_bits, self.escape, self.escape_bits = known, known_bits, escape, escape_bits

    @classmethod
    def arrays(cls, trees: list[tuple[dict, dict]], order: int) -> tuple:
        """What the constructor takes: plain arrays, which any worker can unpickle."""
        known = sorted({k for t, _ in trees for k in t}, key=packed)
        escape = sorted({k for _, t in trees for k in t}, key=packed)
        return (order, len(trees),
                np.array([packed(k) for k in known], dtype=np.uint64),
                np.array([[cls._bits(k, *t) for t in trees] for k in known]).reshape(len(known), len(trees)),
                np.array([packed(k) for k in escape], dtype=np.uint64),
                np.array([[t[1].get(k, 0.0) for t in trees] for k in escape]).reshape(len(escape), len(trees)))

    @staticmethod
    def _bits(key: bytes, known: dict, escape: dict) -> float:
        bits = 0.0
        for a in range(len(key)):
            got = known.get(key[a:])
            if got is not None:
                return bits + got
            bits += escape.get(key[a:-1], 0.0)
        return bits + 8.0

    @staticmethod
    def _find(keys, values, wanted, out, where):
        """Add the rows of ``values`` for ``wanted`` to ``out[where]``; which were found."""
        if not len(keys):
            return np.zeros(len(wanted), dtype=bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        out[where[hit]] += values[at[hit]]
        return hit

    def code(self, words: list[bytes]) -> np.ndarray:
        """Bits of each word in each language."""
        if not words:
            return np.zeros((0, self.n))
        buf = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
        at = np.arange(len(buf))
        blank = np.maximum.accumulate(np.where(buf == 32, at, 0))
        room = np.minimum(self.order, at[1:] - blank[:-1])          # context bytes back to the word's blank
        roll, shift = [buf.astype(np.uint64)], 8
        for k in range(1, self.order + 1):                           # roll[k][i]: bytes i-k..i
            prev = np.zeros_like(roll[0])
            prev[k:] = roll[0][:-k]
            roll.append(roll[-1] | prev << np.uint64(shift))
            shift += 8
        bits = np.zeros((len(buf) - 1, self.n))
        for k in range(self.order, -1, -1):
            here = np.flatnonzero(room == k)
            if not len(here):
                continue
            wanted = roll[k][here + 1] | np.uint64((k + 1) << 56)
            lost = here[~self._find(self.known, self.known_bits, wanted, bits, here)]
            ctx = (roll[k - 1][lost] | np.uint64(k << 56)) if k else np.zeros(len(lost), dtype=np.uint64)
            self._find(self.escape, self.escape_bits, ctx, bits, lost)
            if k:
                room[lost] = k - 1
            else:
                bits[lost] += 8.0
        lengths = np.array([len(w) + 1 for w in words])
        return np.add.reduceat(bits, np.cumsum(lengths) - lengths)


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, order: int = ORDER,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, tuple[dict, dict]]:
    """A frozen tree per language from at most ``train_docs`` whole documents of each.

    ``docs`` holds the rows to learn from; null languages are left out.  The
    trees are bounded by the sample, so they may pass through the driver.
    """
    ids = docs.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"))
    # the k smallest hashes of a language, from arrays of at most k per task
    hashed = ids.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), F.lit("ppm")))
    langs = [r[0] for r in ids.select("lang").distinct().orderBy("lang").collect()]
    chosen = None
    for lang in langs:
        part = hashed.where(F.col("lang") == lang).orderBy("h", "doc_id").limit(train_docs)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return {}
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sample = src.join(F.broadcast(chosen.select("doc_id", "lang")), ["doc_id", "lang"], "left_semi")

    def counted(batches):
        words: dict[str, Counter] = defaultdict(Counter)
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words[lang].update((text or "").encode().split())
        for lang, c in words.items():
            yield out_batch(["lang", "word", "n"], [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())])

    def tree(key, table):
        words = Counter(dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist())))
        known, escape = frozen(grow(words, order))
        return pa.table({"lang": pa.array([key[0].as_py()] * (len(known) + len(escape)), pa.string()),
                         "ctx": pa.array([*known, *escape], pa.binary()),
                         "bits": pa.array([*known.values(), *escape.values()], pa.float64()),
                         "esc": pa.array([False] * len(known) + [True] * len(escape))})

    counts = (sample.select("lang", "text").mapInArrow(counted, "lang string, word binary, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    trees = counts.groupBy("lang").applyInArrow(tree, "lang string, ctx binary, bits double, esc boolean").toArrow()
    model: dict[str, tuple[dict, dict]] = {lang: ({}, {}) for lang in langs}
    for lang, ctx, bits, esc in zip(*(trees.column(c).to_pylist() for c in ("lang", "ctx", "bits", "esc"))):
        model[lang][esc][ctx] = bits
    return model


def identify(docs: DataFrame, model: dict, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), bits (code length of the winner).

    ``und`` with score 0 and null bits for null text, text without a letter,
    or an empty model.  Ties go to the language first in the alphabet.
    """
    langs = sorted(model)
    shared = docs.sparkSession.sparkContext.broadcast(TreeTable.arrays([model[k] for k in langs], order))

    def run(batches):
        trees = TreeTable(*shared.value)
        table: dict[bytes, int] = {}
        costs = np.zeros((TABLE_ROWS, len(langs)))
        for b in slices(batches):
            texts = [t.encode() if langs and t and any(map(str.isalpha, t)) else None for t in b.column(1).to_pylist()]
            cut = [t.split() if t is not None else [] for t in texts]
            new = [w for w in set().union(*cut) if w not in table]
            long = [w for w in new if len(w) > LONG_WORD]
            new = [w for w in new if len(w) <= LONG_WORD]
            if len(table) + len(new) > TABLE_ROWS:
                table.clear()
                new = [w for w in set().union(*cut) if len(w) <= LONG_WORD]
            if len(new) > len(costs):
                costs = np.zeros((len(new), len(langs)))
            costs[len(table):len(table) + len(new)] = trees.code(new)
            table.update(zip(new, range(len(table), len(table) + len(new))))
            rare = dict(zip(long, trees.code(long)))
            pred, score, won = [], [], []
            for text, words in zip(texts, cut):
                if text is None:
                    pred.append("und")
                    score.append(0.0)
                    won.append(None)
                    continue
                total = costs[[table[w] for w in words if len(w) <= LONG_WORD]].sum(axis=0) if rare else costs[[table[w] for w in words]].sum(axis=0)
                if rare:
                    total += sum((rare[w] for w in words if len(w) > LONG_WORD), np.zeros(len(langs)))
                best = int(total.argmin())
                pred.append(langs[best])
                score.append(float(1.0 / np.exp2(np.maximum(total[best] - total, -1000.0)).sum()))
                won.append(float(total[best]))
            yield out_batch(["doc_id", "lang_pred", "score", "bits"],
                            [b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(won, pa.float64())])

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, bits double")
