"""Operator 9 on lists that a group of near copies fills."""

import random

from godown.llm import jaccard_join
from helpers import frame, words
from test_duplicates import brute_components

STATE = "token long, block int, doc long, n long, pos long, root long"
BOUNDS = "a long, b long, lo double, hi double"


def near_group(rng, n, length, edits):
    base = words(rng, length)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(length)] = "e%d" % rng.randrange(10 ** 6)
        out.append(" ".join(w))
    return out


def test_long_lists_are_cut_and_skip_their_own_component(spark, monkeypatch):
    """120 members of one component and an outsider: no task gets the list, no two chunks of the component meet."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    held, write = {}, jaccard_join.written

    def written(df, name):
        held[name] = write(df, name)
        return held[name]
    monkeypatch.setattr(jaccard_join, "written", written)
    rows = [(7, 20, i, 100, 0, 1) for i in range(1, 121)] + [(7, 20, 500, 100, 0, 500)]
    state = spark.createDataFrame(rows, STATE)
    near = [(1, i, 0.05, 0.05) for i in range(2, 121)]
    got = jaccard_join.open_pairs(state, spark.createDataFrame(near, BOUNDS), 80).collect()
    assert sorted((r["a"], r["b"]) for r in got) == [(i, 500) for i in range(1, 121)]      # nothing is known of the outsider
    assert max(len(r["rows"]) for r in held["jaccard_chunks"].collect()) < 40
    assert held["jaccard_meet"].count() <= held["jaccard_chunks"].count()                  # each chunk with the outsider's only
    # the leader's pair with the outsider failed the bitmap filter: that bound rules all of its pairs out
    told = spark.createDataFrame([*near, (1, 500, 0.6, 1.0)], BOUNDS)
    assert jaccard_join.open_pairs(state, told, 80).collect() == []


def test_a_third_of_near_copies_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 6)
    rng = random.Random(11)
    texts = near_group(rng, 50, 90, 2) + near_group(rng, 30, 60, 12) + [" ".join("x%d" % rng.randrange(300) for _ in range(70)) for _ in range(20)]
    ids = rng.sample(range(1000), len(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(frame(spark, texts, ids)).collect()}
    assert got == brute_components(list(zip(ids, texts)))
