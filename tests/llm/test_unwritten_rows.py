"""Operator 10 on rows that don't come straight from files."""

from godown.llm import exact_dedup
from helpers import frame


def test_repeated_and_null_ids_of_an_unwritten_frame(spark):
    docs = frame(spark, ["a  b", "a b", "a b", "x", "x", "y", "y", "z"], [5, 5, None, None, 3, None, None, None])
    got = exact_dedup.exact_dedup(docs).collect()
    assert len({r["locator"] for r in got}) == 8
    assert sorted((r["keep_id"] or 0, r["group_size"]) for r in got if r["kept"]) == [(0, 1), (0, 2), (3, 2), (5, 3)]
    left = exact_dedup.drop_copies(docs.unionByName(docs))
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, " ".join(r["text"].split())) for r in left.collect()) == [(0, "y"), (0, "z"), (3, "x"), (5, "a b")]
