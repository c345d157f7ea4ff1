"""Operator 13: Lyndon arrays and runs against brute force; the query against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from godown.llm import periodic_runs as P
from godown.llm import queries
from godown.llm.words import mix


def lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def runs(s, least=12):
    found, n = [], len(s)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            whole = j + q - i >= max(least, 2 * q)
            if whole and not any(all(s[x] == s[x + d] for x in range(i, j + q - d)) for d in range(1, q)):
                found.append((i, j + q, q))
            i = j + 1
    return sorted(found)


def sequences(seed, count, longest=44):
    r = random.Random(seed)
    for _ in range(count):
        k = r.choice([1, 2, 2, 3, 6])
        s = [r.randrange(k) for _ in range(r.randrange(longest))]
        if s and r.random() < 0.5:
            s = (s[:r.randrange(1, 9)] * 9)[:r.randrange(longest)] + s[:r.randrange(12)]
        yield s


def test_lyndon_arrays():
    for s in sequences(1, 400):
        assert P.lyndon_array(np.array(s, np.int64)).tolist() == lyndon(s)
        assert P.lyndon_array(-np.array(s, np.int64)).tolist() == lyndon([-x for x in s])


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs(least):
    for s in sequences(least, 300):
        assert P.runs_of(np.array(s, np.int64), least) == runs(s, least)


def test_stretches_hold_every_run():
    r = random.Random(5)
    for _ in range(100):
        rows = [s + [100 + r.randrange(50) for _ in range(r.randrange(20))] + s for s in sequences(r.random(), 3)]
        cuts = np.cumsum([0, *map(len, rows)])
        h = mix(np.array([x for s in rows for x in s], np.uint64) + np.uint64(9))
        got = sorted((row, a + x - cuts[row], a + y - cuts[row], p)
                     for row, a, b in P.repeating(h, cuts) for x, y, p in P.runs_of(h[a:b]))
        assert got == sorted((k, *x) for k, s in enumerate(rows) for x in runs(s))


def test_one_word_and_long_texts(spark):
    texts = ["a " * 30_000, "x" * 2_000_000, " ".join(f"w{i % 701}" for i in range(9_000)), " \t", "", None, "a b c"]
    got = P.periodic_runs(spark.createDataFrame([(i % 5, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    rows = sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs], len(r.collapsed)) for r in got.collect())
    assert rows == sorted([(0, 30_000, [(0, 30_000, 1)], 1), (1, 1, [], 2_000_000),
                           (2, 9_000, [(0, 9_000, 701)], len(" ".join(f"w{i}" for i in range(701)))),
                           (3, 0, [], 0), (4, 0, [], 0), (0, 0, [], 0), (1, 3, [], 5)])


def test_words_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(P, "word_hashes", lambda col: (np.ones(20, np.uint64), np.array([0, 20])))
    import pyarrow as pa
    words = [str(i) for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([" ".join(words)])], names=["doc_id", "text"])
    out = next(iter(P.text_runs([batch], "text"))).to_pylist()[0]
    assert out["runs"] == [] and out["collapsed"] == " ".join(words)


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = runs(words)
    gone = {x for a, b, p in found for x in range(a + p, b)}
    top = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *((top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else [None] * 4),
            digest("".join(f"{a},{b - a},{p}\n" for a, b, p in found).encode()),
            digest(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_plain_python(spark, tmp_path):
    r = random.Random(8)
    docs = [(i, " ".join(r.choice(["a", "b c", "é", "dd", "e"]) for _ in range(r.randrange(60)))) for i in range(150)]
    docs += [(i, None) for i in (200, 201)] + [(3, "x y " * 9), (3, "x y " * 9), (None, "q " * 14), (210, ""), (211, "\t\n ")]
    (spark.createDataFrame([(i, t, "a", 1, "w") for i, t in docs], "doc_id long, text string, h string, n int, runs string")
     .write.parquet(str(tmp_path / "documents.parquet")))
    got = queries.QUERIES["op13_lyndon_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, (tuple(x) for x in got.collect()))) == sorted(str(expected(*d)) for d in docs)


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.QUERIES["op13_lyndon_runs"](spark, str(tmp_path)).count() == 0
