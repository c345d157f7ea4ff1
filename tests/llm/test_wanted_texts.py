"""Operator 9: texts that no close pair asks for stay where they are; tables made on the way go."""

import os
import random

from godown.llm import jaccard_join
from helpers import frame, words


def test_only_wanted_texts_are_shuffled(spark):
    ids = [-3, 0, 7, 7, None, *range(1000, 3000)]
    src = frame(spark, ["t%d" % i for i in range(len(ids))], ids).select("doc_id", "text")
    ask = [-3, 0, 7, *range(1000, 3000, 40)]
    got = [tuple(r) for r in jaccard_join.wanted(src, spark.createDataFrame([(i,) for i in ask], "doc_id long")).collect()]
    assert {t for t in zip(ids, ("t%d" % i for i in range(len(ids)))) if t[0] in ask} <= set(got)
    assert len(got) < 600
    assert jaccard_join.wanted(src, spark.createDataFrame([], "doc_id long")).collect() == []


def test_a_full_filter_lets_texts_through(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MOST_BITS", 64)
    src = frame(spark, ["a"] * 500).select("doc_id", "text")
    got = jaccard_join.wanted(src, src.select("doc_id")).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(500))


def test_tables_on_the_way_are_deleted(spark):
    top = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/godown/llm"
    held = lambda: {(k, v) for k in os.listdir(top) for v in os.listdir(f"{top}/{k}")} if os.path.isdir(top) else set()
    rng, before = random.Random(5), held()
    base = words(rng, 80)
    got = jaccard_join.jaccard_components(frame(spark, [" ".join(base), " ".join([*base, "x"]), " ".join(words(rng, 80))], [4, 9, 2]))
    assert [k for k, _ in held() - before] == ["jaccard_members"]
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == [(2, 2), (4, 4), (9, 4)]
