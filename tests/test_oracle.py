"""Every registered query against its SQL twin in DuckDB, on the sf0.001 tables.

The driver runs the same comparison at sf0.01; ``tools/check_oracle.py``
runs it by hand at any scale.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from godown.plans.registry import load_all  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from check_types import SPARK_TO_DUCK  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

QUERIES, ORACLE = load_all()
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = ORACLE[name]
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    spark_types = {c: SPARK_TO_DUCK.get(t, t.upper()) for c, t in df.dtypes}
    assert spark_types == duck_types
    assert len(rows) == len(want)
    assert digest(rows, df.columns, None)[0] == digest(want, cols, None)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["product_id", "product_name", "category", "total_units_sold", "total_revenue",
                          "num_sales_txns", "movement_category"]
