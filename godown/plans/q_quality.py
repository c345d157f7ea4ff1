"""Registered data-quality queries (4.1 - 4.7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from godown.operators import quality
from godown.oracle import with_ctes
from godown.plans.pipeline import Layers
from godown.plans.registry import query

DQ_TABLES = ("inventory", "sales", "orders", "products")
SILVER_CTE = {"inventory": "s_inventory", "sales": "s_sales", "orders": "s_orders", "products": "s_products"}


# The rules written out for SQL: what fails a row, in the order the names are reported.
FAILS = {
    "inventory": {"quantity_on_hand_non_negative": "quantity_on_hand IS NULL OR quantity_on_hand < 0",
                  "reorder_threshold_non_negative": "reorder_threshold IS NULL OR reorder_threshold < 0"},
    "sales": {"quantity_sold_positive": "quantity_sold IS NULL OR quantity_sold <= 0",
              "revenue_non_negative": "revenue IS NULL OR revenue < 0"},
    "orders": {"expected_after_order": "expected_delivery IS NULL OR order_date IS NULL OR expected_delivery < order_date"},
    "products": {"unit_price_positive": "unit_price IS NULL OR unit_price <= 0"},
}

# No product of the feed has a bad price, so some are marked down to nothing.
MARKED_DOWN = 17


def _tagged_sql(t: str) -> str:
    parts = ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in FAILS[t].items())
    source = SILVER_CTE[t]
    if t == "products":
        source = (f"(SELECT * REPLACE (CASE WHEN product_id % {MARKED_DOWN} = 5 THEN 0.0 "
                  f"WHEN product_id % {MARKED_DOWN} = 6 THEN -unit_price ELSE unit_price END AS unit_price) FROM s_products)")
    return f"SELECT *, NULLIF(concat_ws(',', {parts}), '') AS _dq_failed_rule FROM {source}"


def checked(spark, sf_dir, t: str):
    df = getattr(Layers(spark, sf_dir), t)
    if t != "products":
        return df
    k, price = F.col("product_id") % MARKED_DOWN, F.col("unit_price")
    return df.withColumn("unit_price", F.when(k == 5, F.lit(0.0)).when(k == 6, -price).otherwise(price))


def _register(t: str):
    silver = lambda spark, sf_dir: checked(spark, sf_dir, t)

    def passed(spark, sf_dir):
        return quality.split(silver(spark, sf_dir), quality.feed_rules(t))[0]

    def failed(spark, sf_dir):
        return quality.split(silver(spark, sf_dir), quality.feed_rules(t))[1]

    passed.__doc__ = f"4.1: {t} rows passing every rule (what Gold reads)."
    failed.__doc__ = f"4.1 / 4.2: {t} rows failing a rule, tagged; NULL counts as failed (D9)."
    query(f"dq_{t}_passed", with_ctes(
        f"SELECT * EXCLUDE (_dq_failed_rule) FROM ({_tagged_sql(t)}) WHERE _dq_failed_rule IS NULL"))(passed)
    query(f"dq_{t}_quarantine", with_ctes(
        f"SELECT * FROM ({_tagged_sql(t)}) WHERE _dq_failed_rule IS NOT NULL"))(failed)


for _t in DQ_TABLES:
    _register(_t)


_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) FILTER (WHERE _dq_failed_rule IS NULL) AS passed, "
    f"count(*) FILTER (WHERE _dq_failed_rule IS NOT NULL) AS quarantined FROM ({_tagged_sql(t)})" for t in DQ_TABLES)


@query("dq_counts", with_ctes(_COUNTS_SQL))
def q_dq_counts(spark, sf_dir):
    """4.7: passed / quarantined per table, one aggregate each."""
    parts = [quality.rule_counts(checked(spark, sf_dir, t), quality.feed_rules(t), t) for t in DQ_TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)
