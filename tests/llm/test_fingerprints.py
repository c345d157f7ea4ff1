"""Operator 7 against a version in plain Python."""

import hashlib
import math
import random
import re

import pytest
import regex
import xxhash

from godown.llm import imatch
from helpers import DOCS, frame, messy, words


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def term_hash(t):
    return signed(xxhash.xxh64(t.encode(), seed=42).intdigest())


def array_hash(values, last=None):
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v.to_bytes(8, "little", signed=True), seed=seed).intdigest()
    if last is not None:
        seed = xxhash.xxh64(last.encode(), seed=seed).intdigest()
    return signed(seed)


def terms(text):
    return {term_hash(t) for t in regex.split(imatch.TERM_BREAK, (text or "").lower()) if t}


def fingerprint(text, band):
    ts = terms(text)
    kept = sorted(h for h in ts if h % imatch.SLOTS in band)
    out = [array_hash(kept) if kept else array_hash(sorted(ts), "all")]
    for bits, draws in imatch.RATES[1:]:
        for d in range(draws):
            some = [h for h in kept if ((h & (1 << 64) - 1) >> (imatch.DRAW_BITS * d)) & ((1 << bits) - 1) == 0]
            out.append(array_hash(some) if some else None)
    return out


def like(a, b):
    pairs = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
    return sum(x == y for x, y in pairs) / len(pairs)


def brute(texts):
    texts = [t or "" for t in texts]
    df = {}
    for t in texts:
        for s in {h % imatch.SLOTS for h in terms(t)}:
            df[s] = df.get(s, 0) + 1
    low, high = max(2, math.ceil(imatch.BAND[0] * len(texts))), max(2, math.floor(imatch.BAND[1] * len(texts)))
    band = {s for s, n in df.items() if low <= n <= high}
    for i, t in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        a, e = fingerprint(t, band), fingerprint(edited, band)
        yield len(t), hashlib.sha256(edited.encode()).hexdigest(), a, e, like(a, e), like(a, fingerprint(after, band))


def shown(fp):
    return ".".join("-" if x is None else format(x & (1 << 64) - 1, "X").lower() for x in fp)


@pytest.mark.parametrize("buckets", [1, 7, 500])
def test_fingerprints_match_plain_python(spark, buckets):
    rng = random.Random(8)
    texts = messy() + [" ".join(words(rng, 60, 300)) for _ in range(40)] + ["👍🏽 ünï", "a"]
    docs = frame(spark, texts, [i * i - 50 for i in range(len(texts))]).withColumnRenamed("source", "bucket")
    rows = imatch.edited_fingerprints(docs, imatch.lexicon(docs), band_buckets=buckets).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for r, (n, sha, a, e, near, after) in zip(rows, brute(texts)):
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (n, sha, shown(a), shown(e))
        assert r["near_edited"] == pytest.approx(near) and r["near_next"] == pytest.approx(after)


def test_equal_texts_have_equal_fingerprints_and_edits_stay_near(spark):
    rng = random.Random(4)
    texts = [" ".join(words(rng, 150, 6000)) for _ in range(120)]
    texts[17] = texts[90]
    docs = frame(spark, texts)
    rows = imatch.edited_fingerprints(docs, imatch.lexicon(docs)).orderBy("doc_id").collect()
    assert rows[17]["fingerprint"] == rows[90]["fingerprint"]
    assert sum(r["near_edited"] for r in rows) > 4 * sum(r["near_next"] for r in rows)


def test_edges(spark):
    none = spark.createDataFrame([], DOCS)
    assert imatch.edited_fingerprints(none, imatch.lexicon(none)).collect() == []
    one = frame(spark, ["only text"], [5])
    row, = imatch.edited_fingerprints(one, imatch.lexicon(one)).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"only only").hexdigest() and row["near_next"] == 1.0
    twice = frame(spark, ["b c", "b c", None], [1, 1, None])
    assert imatch.edited_fingerprints(twice, imatch.lexicon(twice)).count() == 3


def test_no_python_runs_on_executors(spark):
    docs = frame(spark, messy())
    plan = imatch.edited_fingerprints(docs, imatch.lexicon(docs))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
