"""Registered Gold queries G1-G6 (and the approximate G4 variant)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.functions.exprs import FAST_QUANTILE, SLOW_QUANTILE
from godown.oracle import rnd, with_ctes
from godown.plans import gold
from godown.plans.pipeline import Layers
from godown.plans.registry import query
from godown.session import written
from godown.sources import store

INVENTORY_SNAPSHOT_SQL = """
SELECT i.inventory_id, i.product_id, p.product_name, p.category, i.warehouse_id, w.warehouse_name,
       i.quantity_on_hand, i.reorder_threshold,
       CAST(i.quantity_on_hand AS DOUBLE) * p.unit_price AS stock_value, i.last_updated
FROM s_inventory i
LEFT JOIN s_products p ON i.product_id = p.product_id
LEFT JOIN s_warehouse w ON i.warehouse_id = w.warehouse_id
"""

GOLD_CTES = {
    "g_snapshot": INVENTORY_SNAPSHOT_SQL,
    "g_alerts": "SELECT *, reorder_threshold - quantity_on_hand AS shortfall FROM g_snapshot "
                "WHERE quantity_on_hand < reorder_threshold",
    "g_supplier_perf": f"""
SELECT a.supplier_id, c.supplier_name, a.total_orders,
       {rnd('a.avg_delay', 2)} AS avg_delay_days, {rnd('a.on_time * 100', 1)} AS on_time_pct,
       a.total_qty_ordered, c.rating AS current_rating
FROM (SELECT supplier_id, count(order_id) AS total_orders, avg(delay_days) AS avg_delay,
             avg(CAST(delay_days <= 0 AS INTEGER)) AS on_time,
             CAST(sum(quantity_ordered) AS BIGINT) AS total_qty_ordered
      FROM s_orders GROUP BY supplier_id) a
LEFT JOIN (SELECT supplier_id, supplier_name, rating FROM s_suppliers_scd2 WHERE is_current) c
  ON a.supplier_id = c.supplier_id
""",
    "g_move_base": """
SELECT product_id, CAST(sum(quantity_sold) AS BIGINT) AS total_units_sold,
       sum(CAST(revenue AS DECIMAL(18,2))) AS rev,
       count(sale_id) AS num_sales_txns
FROM s_sales GROUP BY product_id
""",
    "g_move_cuts": "SELECT quantile_cont(total_units_sold, 0.66) AS fast_cut, "
                   "quantile_cont(total_units_sold, 0.33) AS slow_cut FROM g_move_base",
    "g_movement": """
SELECT b.product_id, p.product_name, p.category, b.total_units_sold, CAST(b.rev AS DOUBLE) AS total_revenue,
       b.num_sales_txns,
       CASE WHEN b.total_units_sold >= (SELECT fast_cut FROM g_move_cuts) THEN 'Fast-moving'
            WHEN b.total_units_sold <= (SELECT slow_cut FROM g_move_cuts) THEN 'Slow-moving'
            ELSE 'Medium-moving' END AS movement_category
FROM g_move_base b LEFT JOIN s_products p ON b.product_id = p.product_id
""",
    "g_summary": """
SELECT s.warehouse_id, w.warehouse_name, p.category, CAST(sum(s.quantity_sold) AS BIGINT) AS total_units_sold,
       CAST(sum(CAST(s.revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(s.sale_id) AS num_transactions
FROM s_sales s LEFT JOIN s_products p ON s.product_id = p.product_id
LEFT JOIN s_warehouse w ON s.warehouse_id = w.warehouse_id
GROUP BY s.warehouse_id, w.warehouse_name, p.category
""",
    "g_trend_base": """
SELECT strftime(sale_date, '%Y-%m') AS month, CAST(sum(quantity_sold) AS BIGINT) AS total_units_sold,
       sum(CAST(revenue AS DECIMAL(18,2))) AS rev, count(sale_id) AS num_transactions
FROM s_sales GROUP BY 1
""",
    "g_trends": f"""
SELECT month, total_units_sold, CAST(rev AS DOUBLE) AS total_revenue, num_transactions,
       CASE WHEN month IS NULL THEN NULL ELSE
         {rnd('(CAST(rev AS DOUBLE) - CAST(prev AS DOUBLE)) / NULLIF(CAST(prev AS DOUBLE), 0) * 100', 2)} END
         AS revenue_growth_pct
FROM (SELECT *, lag(rev) OVER (PARTITION BY month IS NULL ORDER BY month) AS prev FROM g_trend_base)
""",
}


def gold_sql(body: str, extra: dict | None = None) -> str:
    return with_ctes(body, {**GOLD_CTES, **(extra or {})})


@query("inventory_snapshot", gold_sql("SELECT * FROM g_snapshot"))
def q_inventory_snapshot(spark, sf_dir):
    return Layers(spark, sf_dir).inventory_snapshot


@query("low_stock_alerts", gold_sql("SELECT * FROM g_alerts"))
def q_low_stock_alerts(spark, sf_dir):
    return Layers(spark, sf_dir).low_stock_alerts


@query("supplier_performance", gold_sql("SELECT * FROM g_supplier_perf"))
def q_supplier_performance(spark, sf_dir):
    return Layers(spark, sf_dir).supplier_performance


@query("product_movement", gold_sql("SELECT * FROM g_movement"))
def q_product_movement(spark, sf_dir):
    return Layers(spark, sf_dir).product_movement


@query("product_movement_approx", gold_sql("SELECT 'fast' AS cut, TRUE AS within_rank_error UNION ALL SELECT 'slow', TRUE "
                                           "WHERE (SELECT count(*) FROM g_move_base) > 0"))
def q_product_movement_approx(spark, sf_dir):
    """7.8: are the sketch's cuts of G4 within rank error 0.01 of the exact rank?  Counted over all products."""
    base = written(gold.movement_base(Layers(spark, sf_dir).sales), "movement_base")
    fast, slow = gold.movement_cuts(base, approx=True)
    cuts = base.select("total_units_sold", fast.alias("fast"), slow.alias("slow"))
    units, n = F.col("total_units_sold"), F.count(F.lit(1))
    # some rank of an existing value lies in [below / n, upto / n]
    row = cuts.agg(*[((F.count_if(units < F.col(c)) <= n * (p + 0.01)) & (F.count_if(units <= F.col(c)) >= n * (p - 0.01))).alias(c)
                     for c, p in (("fast", FAST_QUANTILE), ("slow", SLOW_QUANTILE))])
    return row.select(F.expr("stack(2, 'fast', fast, 'slow', slow) AS (cut, within_rank_error)"))


@query("product_movement_banded", gold_sql("SELECT * FROM g_movement"))
def q_product_movement_banded(spark, sf_dir):
    """G4 from sales summed per product and month (the shared pass of the KPIs); equal to ``product_movement``."""
    return Layers(spark, sf_dir).movement_and_trends()[0]

@query("sales_summary", gold_sql("SELECT * FROM g_summary"))
def q_sales_summary(spark, sf_dir):
    return Layers(spark, sf_dir).sales_summary


@query("sales_trends", gold_sql("SELECT * FROM g_trends"))
def q_sales_trends(spark, sf_dir):
    return Layers(spark, sf_dir).sales_trends


#: Key of each Gold table as text, for the order.
_KEYS = {"inventory_snapshot": ("inventory_id",), "low_stock_alerts": ("inventory_id",), "supplier_performance": ("supplier_id",),
         "product_movement": ("product_id",), "sales_summary": ("warehouse_id", "category"), "sales_trends": ("month",)}
_CTE = {"inventory_snapshot": "g_snapshot", "low_stock_alerts": "g_alerts", "supplier_performance": "g_supplier_perf",
        "product_movement": "g_movement", "sales_summary": "g_summary", "sales_trends": "g_trends"}


def _rank_sql(table: str) -> str:
    order = ", ".join(f"{k[1:]} DESC NULLS LAST" if k.startswith("-") else f"{k} ASC NULLS FIRST" for k in gold.ORDERING[table])
    key = " || '/' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in _KEYS[table])
    return f"SELECT '{table}' AS table_name, row_number() OVER (ORDER BY {order}) AS rank, {key} AS row_key FROM {_CTE[table]}"


@query("gold_order", gold_sql(" UNION ALL ".join(_rank_sql(t) for t in _KEYS)))
def q_gold_order(spark, sf_dir):
    """9.1 - 9.3: rank and key of every row of the six Gold tables, written in presentation order."""
    tables = Layers(spark, sf_dir).gold_tables()
    parts = []
    for name, key in _KEYS.items():
        rows = store.ranked(written(store.ordered(tables[name], gold.order_of(name)), "gold_order"))
        text = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in key])
        parts.append(rows.select(F.lit(name).alias("table_name"), "rank", text.alias("row_key")))
    return reduce(DataFrame.unionByName, parts)
