"""Plan-shape checks: what the physical plans must (not) contain to scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from godown.operators import clean
from godown.plans import gold
from godown.plans.pipeline import Layers
from godown.plans.registry import load_all

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
# the work of these is done when they are called; the plan is a scan of what landed
STATEFUL = {"bronze_batch_lineage", "bronze_stream_available_now", "bronze_schema_evolution", "bronze_stream_scd2",
            "bronze_stream_scd2_late", "bronze_evolving_tables", "bronze_header_order", "bronze_old_file", "pipeline_silver_sales",
            "pipeline_quarantine", "pipeline_counts", "table_counts", "bronze_stream_scd2_irregular", "bronze_stream_scd2_quarantine",
            "pipeline_suppliers_quarantine", "pipeline_dirty_sales", "pipeline_rescued", "bronze_inferred_schema", "bronze_date_format"}
QUERIES, _ = load_all()
#: Most scans of a table in one plan.
MOST_SCANS = {"part": 4, "supplier": 10, "lineitem": 3, "orders": 2, "nation": 2, "region": 2, "customer": 2, "events": 2}


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STATEFUL))
def test_no_cartesian_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in text, f"{name}: {bad}"


def test_column_pruning_reaches_the_scan(spark):
    text = plan(Layers(spark, SF_SMALL).sales_summary)
    scans = [ln for ln in text.splitlines() if "ReadSchema" in ln and "l_partkey" in ln]
    assert scans, text
    for ln in scans:
        assert "l_tax" not in ln and "l_returnflag" not in ln and "l_discount" not in ln


def test_dedupe_limits_before_the_shuffle(spark):
    text = plan(clean.dedupe(Layers(spark, SF_SMALL).raw("sales"), ["sale_id"]), "simple")
    lines = [ln.strip() for ln in text.splitlines()]
    partial = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Partial" in ln]
    exchange = [i for i, ln in enumerate(lines) if ln.lstrip("+- :").startswith("Exchange hashpartitioning")]
    assert partial and exchange and min(partial) > min(exchange)   # deeper in the tree = before the shuffle


def test_facts_aggregate_before_dimension_join(spark):
    text = plan(Layers(spark, SF_SMALL).sales_summary, "simple")
    # partial aggregation of sales sits below (after, in text order) the first join
    first_join = min(i for i, ln in enumerate(text.splitlines()) if "Join" in ln)
    partial = [i for i, ln in enumerate(text.splitlines()) if "partial_sum" in ln]
    assert partial and max(partial) > first_join


def test_low_stock_filter_runs_before_the_joins(spark):
    text = plan(Layers(spark, SF_SMALL).low_stock_alerts, "simple")
    lines = text.splitlines()
    filt = [i for i, ln in enumerate(lines) if "Filter" in ln and "quantity_on_hand" in ln and "<" in ln]
    dim_joins = [i for i, ln in enumerate(lines) if "Join" in ln and ("product_id" in ln or "warehouse_id" in ln)]
    assert filt and dim_joins and min(filt) > max(dim_joins)   # deeper than both dimension joins


@pytest.fixture()
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["inventory_snapshot", "supplier_performance", "product_movement", "sales_summary",
                                  "scd2_asof_join", "scd2_apply_batch", "line_price_lookup",
                                  "kpi_scalars", "clean_products_category_median"])
def test_large_scale_plans_keep_equi_joins(spark, no_broadcast, name):
    """With nothing small enough to broadcast (as at 100 TB), every join stays a keyed shuffle join."""
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    joins = text.count("SortMergeJoin") + text.count("ShuffledHashJoin")
    # only the bounded hot-key table of the as-of join, on both of its sides
    assert joins > 0 or name == "scd2_asof_join"
    assert text.count(") BroadcastHashJoin") == (2 if name == "scd2_asof_join" else 0), text


def scans(df) -> dict[str, int]:
    """Scans of each given table in the physical plan."""
    found: dict[str, int] = {}
    for path in re.findall(r"Location: \w+ ?(?:\([^)]*\))?\[([^\]]*)\]", plan(df)):
        table = re.search(r"/(\w+)\.parquet", path)
        if table:
            found[table[1]] = found.get(table[1], 0) + 1
    return found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STATEFUL))
def test_plans_read_each_table_a_few_times(spark, name):
    """A plan that is used in many places re-reads its tables; no registered plan does.

    One read per use: products are read for their rows and their re-sent
    ones, suppliers once per snapshot file and use, three feeds are lines.
    """
    for table, n in scans(QUERIES[name](spark, SF_SMALL)).items():
        assert n <= MOST_SCANS[table], f"{name} scans {table} {n} times"


@pytest.mark.parametrize("name, table, n", [("inventory_snapshot", "lineitem", 1), ("low_stock_alerts", "lineitem", 1),
                                            ("product_movement", "lineitem", 0), ("scd2_asof_join", "lineitem", 1),
                                            ("kpi_scalars", "lineitem", 2)])
def test_fact_is_evaluated_once(spark, name, table, n):
    """``product_movement`` reads written totals, the KPIs stock and orders beside them."""
    assert scans(QUERIES[name](spark, SF_SMALL)).get(table, 0) == n
