"""Registered queries against their SQL, and the shapes the contracts fix."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from godown.llm.queries import ORACLE, QUERIES

SHAPES = {
    "op1": ("page_id", "host", "path", "rule", "verdict"), "op2": ("doc_id", "held_out", "score", "predicted"),
    "op3": ("doc_id", "held_out", "lang_pred", "score"), "op4": ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"),
    "op5": ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"), "op6": ("doc_id", "held_out", "score", "predicted"),
    "op7": ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"),
    "op8": ("doc_id", "n_words", "n_removed", "kept_sha256"), "op9": ("doc_id", "n_shingles", "component_id"),
    "op10": ("doc_id", "keep_id", "group_size", "kept", "text_sha256"),
    "op11": ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
    "op12": ("page_id", "url", "text", "n_chars"),
    "op13": ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"),
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_one_query_per_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(SHAPES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_every_row(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert set(SHAPES[name.split("_")[0]]) <= set(df.columns)
    rows = sorted(map(tuple, df.collect()), key=str)
    if name in ORACLE:
        cur = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE[name]})")
        assert rows == sorted(map(tuple, cur.fetchall()), key=str)
    else:
        assert len({r[0] for r in rows}) == spark.read.parquet(f"{SF_SMALL}/{'pages' if df.columns[0] == 'page_id' else 'documents'}.parquet").count()
