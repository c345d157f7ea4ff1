"""Toxic passages by maximum-scoring segments (operator 6).

Token scores are log-odds between toxic and other labelled texts under an
informative Dirichlet prior (the pooled counts), shrunk by their standard
error, minus a drift that makes the expected score of clean text negative.
A linear scan (Ruzzo and Tompa) then finds all maximal segments of a text.
Segment scores of clean text follow an extreme-value law: a text of n tokens
is expected to hold K n exp(-lambda s) segments of score s or more.  Lambda
solves the Karlin-Altschul equation over the clean token counts, K comes
from the clean training texts.  A text's score is a logistic function of its
surprise, lambda s - ln(K n) summed over significant segments, calibrated on
the training texts; texts without a significant segment share a base rate.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.common import out_batch, slices, written

#: Labelled documents that are learned from, of class 0 and 1: the first in order of a hash of their id.
TRAIN_PER_CLASS = (4000, 1500)
#: Weight of the prior (the pooled counts), as a share of all counts.
PRIOR = 0.05
#: Tokens whose log-odds are nearer to 0 than this many standard errors score as the drift alone.
MIN_Z = 2.5
#: Nor do tokens below this log-odds score: they are chance, or marks of a group of copies.
MIN_ODDS = 2.5
#: A token without evidence of its own scores as its longest beginning that has some, of these lengths.
STEMS = (4, 5, 6)
DRIFT = 0.5
TABLE_ROWS = 300_000
STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def norm(token: str) -> str:
    return token.strip(STRIP).lower()


def stems(token: str) -> list[str]:
    """The token itself, then its beginnings (marked), longest first."""
    return [token, *(token[:n] + "*" for n in reversed(STEMS) if len(token) >= n)]


def token_score(token: str, odds: dict) -> float:
    for s in stems(token):
        got = odds.get(s)
        if got is not None:
            return got
    return 0.0


def learn(tokens, labels) -> dict[str, float]:
    """Log-odds of tokens and beginnings.

    A token counts once per text, so one long rant doesn't make a word
    toxic; what stands out then counts once per preceding token, so a group
    of copies doesn't either.
    """
    once = [Counter(), Counter()]
    for t, y in zip(tokens, labels):
        once[y].update({s for w in set(t) for s in stems(w)})
    sums = [sum(c.values()) for c in once]
    first = log_odds(once[1], once[0], *reversed(sums))
    seen: list[set] = [set(), set()]
    for t, y in zip(tokens, labels):
        for before, w in zip(["", *t], t):
            seen[y].update((before, s) for s in stems(w) if s in first)
    apart = [Counter(s for _, s in pairs) for pairs in seen]
    again = log_odds(apart[1], apart[0], *reversed(sums))
    return {w: min(d, first[w]) for w, d in again.items()}


def log_odds(toxic: Counter, other: Counter, a: int, b: int, prior: float = PRIOR) -> dict[str, float]:
    """Shrunk log-odds of each token (a, b: all counts of either class); those within MIN_Z errors of 0 are left out."""
    both = toxic + other
    total = a + b
    prior *= total
    out = {}
    for t, n in both.items():
        m = prior * n / total
        x, y = toxic[t] + m, other[t] + m
        d = math.log(x / (a + prior - x)) - math.log(y / (b + prior - y))
        z = d / math.sqrt(1 / x + 1 / y)
        if abs(z) >= MIN_Z and abs(d) >= MIN_ODDS:
            out[t] = d * (1 - (MIN_Z / z) ** 2)
    return out


def segments(scores) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) of a score sequence, in linear time."""
    scores = np.asarray(scores, dtype=np.float64)
    cum = np.cumsum(scores)
    stack: list[list] = []        # first, end, sum before, sum through, nearest earlier one with a lower sum before
    for i in np.flatnonzero(scores > 0).tolist():
        left, right = float(cum[i] - scores[i]), float(cum[i])
        first, end = i, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append([first, end, left, right, j])
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s[0], s[1], s[3] - s[2]) for s in stack]


def karlin(values, weights) -> float:
    """lambda > 0 with sum w exp(lambda v) = 1, for a negative mean and some positive value."""
    v, w = np.asarray(values, dtype=np.float64), np.asarray(weights, dtype=np.float64)
    w = w / w.sum()
    lo, hi = 1e-6, 1.0
    while (w * np.exp(np.minimum(hi * v, 500))).sum() < 1 and hi < 100:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (w * np.exp(np.minimum(mid * v, 500))).sum() < 1 else (lo, mid)
    return (lo + hi) / 2


def surprise(found, n: int, lam: float, k: float) -> float:
    """Sum over segments of max(0, lambda s - ln(K n)); for none, the best segment's (negative) value."""
    if not n:
        return -20.0
    base = math.log(max(k * n, 1e-12))
    each = [lam * s - base for _, _, s in found]
    over = sum(e for e in each if e > 0)
    return min(60.0, over) if over > 0 else max(-20.0, max(each, default=-20.0))


def extreme_values(tokens, labels, odds: dict) -> dict:
    """The drift, lambda and K of the clean texts under some log-odds."""
    counts = Counter(w for t, y in zip(tokens, labels) if y == 0 for w in t)
    clean = sum(counts.values()) or 1
    score = {w: token_score(w, odds) for w in counts}
    drift = DRIFT + max(0.0, sum(score[w] * n for w, n in counts.items()) / clean)   # a negative mean on clean text
    each = Counter()
    for w, n in counts.items():
        each[round(score[w] - drift, 6)] += n
    if not any(v > 0 for v in each):
        each[1.0] += 1e-3                                  # no clean token scores above 0: a floor for lambda
    lam = karlin(list(each), list(each.values()))
    # clean texts hold K n exp(-lambda s) segments above s: K from the smallest one
    found = [f[2] for t, y in zip(tokens, labels) if y == 0 for f in segments([score[w] - drift for w in t])]
    k = max(len(found), 0.5) / clean * math.exp(lam * min(found, default=1.0))
    return {"scores": odds, "drift": drift, "lam": lam, "k": k}


def text_surprise(tokens, m: dict) -> float:
    return surprise(segments([token_score(w, m["scores"]) - m["drift"] for w in tokens]), len(tokens), m["lam"], m["k"])


def fit(texts, labels, weights=(1.0, 1.0)) -> dict:
    """The model: log-odds, drift, lambda, K, and the logistic's slope and shift.

    Every third text of a class is kept from learning and calibrates the
    logistic, so tokens that are toxic by chance don't make it overconfident.
    ``weights``: how many rows a row of class 0 / 1 stands for.
    """
    tokens = [[t for t in map(norm, (x or "").split()) if t] for x in texts]
    labels = np.asarray(labels)
    aside = np.zeros(len(tokens), dtype=bool)
    for y in (0, 1):
        aside[np.flatnonzero(labels == y)[2::3]] = True
    known = [(tokens[i], labels[i]) for i in np.flatnonzero(~aside)]
    m = extreme_values(*zip(*known), learn(*zip(*known)))
    x = np.array([text_surprise(tokens[i], m) for i in np.flatnonzero(aside)])
    y = labels[aside]
    w = np.where(y == 1, weights[1], weights[0])
    over = x > 0                          # texts with a significant segment; the others share one base rate
    base = min(0.49, float((w * y)[~over].sum() / max(w[~over].sum(), 1e-9)))
    slope, shift = logistic(x[over], y[over], w[over]) if len(set(y[over].tolist())) == 2 else (1.0, 0.0)
    return m | {"slope": slope, "shift": shift, "base": base}


def probability(x: float, m: dict) -> float:
    """The score of a text with surprise x; never falls as x grows."""
    if x <= 0:
        return m["base"] * 2.0 ** (x / 20)
    return max(m["base"], 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, m["slope"] * x + m["shift"])))))


def logistic(x, y, weights, steps: int = 60) -> tuple[float, float]:
    """Slope and shift of P(y = 1 | x) by Newton steps with a small ridge."""
    x, y = np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)
    scale = max(float(np.abs(x).max()), 1.0)
    a = np.stack([x / scale, np.ones(len(x))], axis=1)
    w = np.asarray(weights) / np.sum(weights)
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        ridge = 1e-5 * np.eye(2)
        b += np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (w * (y - p)) - ridge @ b)
    return float(b[0] / scale), float(b[1])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: tuple[int, int] = TRAIN_PER_CLASS,
          id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """Fit on at most ``per_class[y]`` whole documents of class y; None if a class has none."""
    marked = (labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxic"))))
    there = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    weights = [max(1.0, there.get(y, 0) / per_class[y]) for y in (0, 1)]
    ids = None
    for y in (0, 1):
        part = marked.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class[y])
        ids = part if ids is None else ids.unionByName(part)
    ids = written(ids.select("doc_id", "y").distinct(), "toxic_ids")
    sample = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
              .join(F.broadcast(ids), "doc_id").select("y", "doc_id", "text"))     # at most sum(per_class) rows
    kind = "name string, value double"

    def run(table):
        table = table.sort_by([("doc_id", "ascending"), ("y", "ascending")])
        y = table.column("y").to_pylist()
        if len(set(y)) < 2:
            return pa.table({"name": pa.array([], pa.string()), "value": pa.array([], pa.float64())})
        m = fit(table.column("text").to_pylist(), y, weights)
        rows = [(" " + k, m[k]) for k in ("drift", "lam", "k", "slope", "shift", "base")] + list(m["scores"].items())
        return pa.table({"name": pa.array([r[0] for r in rows]), "value": pa.array([r[1] for r in rows], pa.float64())})

    rows = sample.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(run, kind).collect()
    if not rows:
        return None
    return {r["name"][1:]: r["value"] for r in rows if r["name"].startswith(" ")} | {
        "scores": {r["name"]: r["value"] for r in rows if not r["name"].startswith(" ")}}


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), passages: array of (first token, end token, score) of every significant segment.

    Significant: fewer than one segment of that score is expected in clean
    text of that length.  Null and empty text holds no segment and gets the
    lowest score; without a model every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        table: dict[str, float] = {}
        for b in slices(batches):
            out, spans = [], []
            for text in b.column(1).to_pylist():
                if m is None:
                    out.append(0.0)
                    spans.append([])
                    continue
                if len(table) > TABLE_ROWS:
                    table.clear()
                scores = []
                for t in (text or "").split():
                    s = table.get(t)
                    if s is None:
                        w = norm(t)
                        s = table[t] = token_score(w, m["scores"]) - m["drift"] if w else 0.0
                    scores.append(s)
                n = len(scores)
                found = segments(scores) if scores else []
                base = math.log(max(m["k"] * n, 1e-12)) if n else 0.0
                spans.append([{"first": a, "end": e, "score": s} for a, e, s in found if m["lam"] * s > base])
                out.append(probability(surprise(found, n, m["lam"], m["k"]), m))
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield out_batch(["doc_id", "score", "passages"], [b.column(0), pa.array(out, pa.float64()), pa.array(spans, kind)])

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double, "
                               "passages array<struct<first: long, end: long, score: double>>")
