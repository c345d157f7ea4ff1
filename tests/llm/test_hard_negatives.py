"""Operator 11 against brute force, and its edges."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from godown.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, kin string, shard string, v string, bucket string"


def brute(rows, positives=5, negatives=5, low=80, high=100, anchors=lambda i: i % 5 == 0):
    usable = {}
    for i, e, c in sorted((r for r in rows if r[0] is not None and r[2] is not None), key=lambda r: (r[0], r[2])):
        if e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        vec = [int(np.floor(256 * float(np.float32(x)))) for x in e]
        usable[i] = min(usable.get(i, (c, vec)), (c, vec))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for i, (c, e) in usable.items():
        if not anchors(i):
            continue
        scores = [(-dot(e, w), j, d) for j, (d, w) in usable.items() if j != i]
        for s, p, _ in sorted(x for x in scores if x[2] == c)[:positives]:
            fit = sorted((t, n) for t, n, d in scores if d != c and low * -s <= 100 * -t <= high * -s)[:negatives]
            out.update((i, p, k + 1, n, -s, -t) for k, (t, n) in enumerate(fit))
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, e, c, "x", "y", "z", None) for i, e, c in rows], SCHEMA)
    ints = H.integer_rows(df)
    got = H.hard_negatives(ints, ints.where("vec_id % 5 = 0"), **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    return set(found)


def some_rows(n, seed, width=6):
    r = random.Random(seed)
    near = [r.gauss(0, 1) for _ in range(width)]
    rows = []
    for i in range(n):
        e = [r.gauss(0, 1) * 0.4 + (x if i % 3 else 0) for x in near]
        scale = r.choice([0.01, 0.3, 1, 1, 5])
        rows.append((i, [scale * x for x in e], r.randrange(4)))
    rows += [(n + k, rows[3][1], k % 4) for k in range(20)]                      # a group of copies: ties
    rows += [(n + 30, [0.0] * width, 1), (n + 31, [], 2), (n + 32, rows[4][1][:3], 0)]   # zero, empty, shorter
    rows += [(n + 40, None, 1), (n + 41, [None] + rows[0][1][1:], 1), (n + 42, [float("nan")] * width, 1),
             (n + 43, [float("inf")] * width, 1), (n + 44, rows[5][1], None), (None, rows[5][1], 1)]
    return rows + [rows[7], (8, rows[9][1], 3), (n + 45, [3e38] * width, 1)][:2]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_over_many_cells(spark, monkeypatch, seed):
    monkeypatch.setattr(H, "SHARD", 25)
    monkeypatch.setattr(H, "BLOCK", 7)
    monkeypatch.setattr(H, "SEED", 40)
    rows = some_rows(130, seed)
    assert run(spark, rows) == brute(rows)


def test_too_long_vectors_take_no_part(spark):
    rows = [(i, [float(i), 1.0], i % 2) for i in range(12)]
    assert run(spark, rows + [(15, [3e38, 0.0], 1)]) == brute(rows)


def test_empty_table_and_lone_labels(spark):
    assert run(spark, []) == set()
    assert run(spark, [(5, [1.0], 1), (6, [1.0], 2)]) == set()


def test_candidates_lose_no_score(monkeypatch):
    r = np.random.default_rng(3)
    vectors = np.concatenate([r.integers(-300, 300, (400, 8)), r.integers(-300, 300, (60, 1)) * np.ones((60, 8), np.int64)])
    shard = H.Shard(vectors)
    pruned = 0
    for a in vectors[::7]:
        scores = vectors @ a
        for share in (0.3, 0.7, 0.9, 0.99):
            least = float(share * (a @ a))
            at = shard.candidates(a, least)
            if at is not None:
                pruned += len(vectors) - len(at)
                assert set(np.flatnonzero(scores >= least)) <= set(at.tolist())
    assert pruned > 1000
