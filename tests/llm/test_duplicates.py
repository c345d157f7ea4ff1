"""Operators 8, 9 and 10 against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from godown.llm import exact_dedup, jaccard_join, substring_dedup
from godown.llm import words as hashing
from godown.session import scratch_path
from helpers import DOCS, frame, messy, words

WORD = re.compile("[^\x20\x09-\x0d]+")


# -- words

def test_word_hashes_follow_the_words():
    texts = ["a b", None, "", "  Ab\tab\n", "é日本 é", "x" * 5000 + " b", " "]
    h, cuts = hashing.word_hashes(pa.array(texts))
    got = [h[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
    assert [len(g) for g in got] == [len(WORD.findall(t or "")) for t in texts]
    seen = {}
    for t, g in zip(texts, got):
        for w, x in zip(WORD.findall(t or ""), g):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    low, _ = hashing.word_hashes(pa.array(["AB ab É é"]), lower=True)
    assert low[0] == low[1] and low[2] != low[3]
    part, _ = hashing.word_hashes(pa.array(["q", "a b", "z"]).slice(1, 1))
    assert part.tolist() == got[0]


# -- operator 8

def brute_substrings(rows):
    first, out = {}, {}
    for i, t in rows:
        ws = WORD.findall(t or "")
        for k in range(len(ws) - 12):
            w = tuple(ws[k:k + 13])
            first[w] = min(first.get(w, i), i)
    for i, t in rows:
        ws = WORD.findall(t or "")
        gone = set()
        for k in range(len(ws) - 12):
            if first[tuple(ws[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.setdefault(i, []).append((len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def substrings(docs):
    out = {}
    for r in substring_dedup.dedup_substrings(docs).collect():
        out.setdefault(r["doc_id"], []).append((r["n_words"], r["n_removed"], r["kept_sha256"]))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("least,index_words", [(8, 400_000), (2, 300), (10 ** 9, 50)])
def test_substrings_match_brute_force(spark, monkeypatch, least, index_words):
    """Hot windows and many small indexes change nothing."""
    monkeypatch.setattr(substring_dedup, "LEAST", least)
    monkeypatch.setattr(substring_dedup, "INDEX_WORDS", index_words)
    monkeypatch.setattr(substring_dedup, "SAMPLE", 2)
    monkeypatch.setattr(substring_dedup.judge_shard, "__defaults__", (index_words, 13, 4))
    texts = messy()
    rng = random.Random(1)
    common = words(rng, 30)
    texts += [" ".join(words(rng, rng.randint(0, 9)) + common + words(rng, rng.randint(0, 9))) for _ in range(30)]
    rows = [((i * 7919) % 101, t) for i, t in enumerate(texts)]           # ids in another order, some repeated
    assert substrings(frame(spark, [t for _, t in rows], [i for i, _ in rows])) == brute_substrings(rows)


def test_substring_edges(spark):
    assert substrings(spark.createDataFrame([], DOCS)) == {}
    text = " ".join(map(str, range(40)))
    got = substrings(frame(spark, [text, text, text], [3, 3, None]).withColumnRenamed("lang", "text_hash"))
    assert [n[1] for n in got[3]] == [0, 0] and got[None][0][1] == 40
    carried = substring_dedup.dedup_substrings(frame(spark, [text, text]), carry=["lang", "n_chars"]).collect()
    assert {r["carried"]["lang"] for r in carried} == {"en"}


def test_backward_search_finds_every_interval():
    rng = np.random.default_rng(2)
    text = np.concatenate([np.concatenate([rng.integers(1, 4, rng.integers(5, 30)), [0]]) for _ in range(20)])
    index = substring_dedup.FMIndex(text, 5)
    starts = np.flatnonzero(np.concatenate([[True], text[:-1] == 0]))
    ends = np.flatnonzero(text == 0)
    rows = index.windows(text, starts, ends - starts)
    for s, e, row in zip(starts, ends, rows):
        for k in range(e - s - 4):
            here = [j for j in range(len(text) - 4) if (text[j:j + 5] == text[s + k:s + k + 5]).all()]
            lo, hi = index.window[0][row[k]], index.window[1][row[k]]
            assert sorted(index.order[lo:hi].tolist()) == here
    for c in range(1, 4):                                                  # rank by the wavelet matrix
        bwt = text[index.order - 1]
        lo, hi = index.step(np.array([c, c]), np.array([0, 7]), np.array([len(text), 23]))
        assert hi[0] - lo[0] == (bwt == c).sum() and hi[1] - lo[1] == (bwt[7:23] == c).sum()


# -- operator 9

def brute_components(rows):
    sets = {}
    for i, t in rows:
        ws = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")]
        sets[i] = {tuple(ws[k:k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                c = len(sets[x] & sets[y])
                if 100 * c >= 80 * (len(sets[x]) + len(sets[y]) - c):
                    a, b = find(x), find(y)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, n):
    base = words(rng, 90)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "e%d" % rng.randrange(10 ** 6)
        if rng.random() < 0.4:
            w = w[rng.randint(0, 12):len(w) - rng.randint(0, 12)]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed,sample,block", [(1, 16, 512), (2, 1, 512), (3, 1, 3)])
def test_components_match_brute_force(spark, monkeypatch, seed, sample, block):
    monkeypatch.setattr(jaccard_join, "SAMPLE", sample)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(seed)
    texts = messy(seed) + near_copies(rng, 40) + near_copies(rng, 25) + ["A b c d", "a B c d", "a b c d e", "a b c"]
    ids = rng.sample(range(1000), len(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(frame(spark, texts, ids)).collect()}
    assert got == brute_components(list(zip(ids, texts)))


def test_jaccard_edges(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], DOCS)).collect() == []
    docs = frame(spark, [None, "", " ", "same text", "same text", "same text"], [1, 2, 3, 9, 9, 4]).withColumnRenamed("source", "n")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (9, 1, 4), (9, 1, 4)]


def test_bitmaps_bound_the_symmetric_difference():
    rng = np.random.default_rng(0)
    for n, m, common in ((10, 12, 5), (300, 260, 250), (1000, 90, 40), (0, 5, 0)):
        pool = rng.integers(0, 2 ** 63, n + m, dtype=np.uint64)
        a, b = pool[:n], np.concatenate([pool[:common], pool[n:n + m - common]])
        assert jaccard_join.bitmap_distance(jaccard_join.bitmap(a), jaccard_join.bitmap(b)) <= n + m - 2 * common
    assert jaccard_join.bitmap_distance(jaccard_join.bitmap(a), jaccard_join.bitmap(a)) == 0


# -- operator 10

def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    return sorted((i, min(groups[n]), len(groups[n]), hashlib.sha256(n.encode()).hexdigest())
                  for i, t in rows for n in [re.sub("[\x20\x09-\x0d]+", " ", t or "")])


@pytest.mark.parametrize("files", [1, 1000])
def test_exact_groups_match_brute_force(spark, files):
    texts = messy() * 2
    got = exact_dedup.exact_dedup(frame(spark, texts).repartition(5), files_per_trigger=files).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["digest"]) for r in got) == brute_exact(list(enumerate(texts)))
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_equal_digests_with_other_bytes_are_told_apart(spark):
    texts = messy()
    short = lambda c: F.substring(F.sha2(c, 256), 1, 1)  # noqa: E731  16 digests: collisions everywhere
    got = exact_dedup.exact_dedup(frame(spark, texts), digest=short).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [x[:3] for x in brute_exact(list(enumerate(texts)))]


def test_state_goes_on_from_its_checkpoint(spark):
    feed, state = scratch_path(spark, "t_feed"), scratch_path(spark, "t_state")
    rows = spark.createDataFrame([(7, "x", "aa"), (8, "y", "bb")], "doc_id long, locator string, digest string")
    rows.write.parquet(feed)
    exact_dedup.stream_state(spark, feed, rows.schema, state)
    spark.createDataFrame([(3, "z", "aa"), (9, "u", "aa")], rows.schema).write.mode("append").parquet(feed)
    got = {r["digest"]: (r["keep_id"], r["keep_locator"], r["group_size"]) for r in exact_dedup.stream_state(spark, feed, rows.schema, state).collect()}
    assert got == {"aa": (3, "z", 3), "bb": (8, "y", 1)}


def test_exact_edges(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], DOCS)).collect() == []
    path = scratch_path(spark, "t_docs")
    docs = frame(spark, ["a  b", "a\tb", "a b", None, "", " "], [5, 5, None, 2, 1, 4]).withColumnRenamed("lang", "digest").withColumnRenamed("source", "locator")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    got = exact_dedup.exact_dedup(docs).collect()
    assert sorted((r["keep_id"], r["group_size"]) for r in got if r["kept"]) == [(1, 2), (4, 1), (5, 3)]
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == 3
