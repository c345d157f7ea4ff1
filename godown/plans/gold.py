"""Gold KPI tables G1-G6 as lazy DataFrame plans.

Scale notes (the facts are sales, orders and inventory; the dimensions are
products, warehouses and the current suppliers):

* Facts are aggregated on their own keys *before* they meet a dimension
  (product_movement, supplier_performance, sales_summary).  Partial
  aggregation runs map-side, so a product or supplier holding a third of
  all rows is cut down to one row per map task before any shuffle.
* No broadcast hint is put on data-derived dimensions: AQE turns a join
  into a broadcast join only when the measured shuffle output is below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it stays a
  sort-merge join.  The un-aggregated fact of G1 meets its dimensions by
  ``split_join`` (``operators/joins``), so AQE can split a hot product.
* Quantile cuts come from a written table of values and counts; both at once.
* Plans are not globally sorted; ``ORDERING`` states the presentation order.
  The job writes Gold in that order (``store.ordered``), and ``store.ranked``
  gives readers the rank (top-n reads use ``orderBy().limit()``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from godown.functions.exprs import FAST_QUANTILE, SLOW_QUANTILE, classify_movement, growth_pct, month_bucket
from godown.operators.joins import split_join
from godown.operators.quantiles import quantile_values
from godown.session import written

# Presentation order of each Gold table (descending measure, key as tie-break).
ORDERING = {
    "inventory_snapshot": ("inventory_id",),
    "low_stock_alerts": ("-shortfall", "inventory_id"),
    "supplier_performance": ("-on_time_pct", "supplier_id"),
    "product_movement": ("-total_units_sold", "product_id"),
    "sales_summary": ("-total_revenue", "warehouse_id", "category"),
    "sales_trends": ("month",),
}


def order_of(table: str) -> list:
    """The presentation order of a Gold table as sort columns."""
    return [F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_first(k) for k in ORDERING[table]]


def ordered(df: DataFrame, table: str) -> DataFrame:
    """The table in its presentation order (a global sort; use for final output only)."""
    return df.orderBy(*order_of(table))


def current_suppliers(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current"))


def inventory_snapshot(inventory: DataFrame, products: DataFrame, warehouse: DataFrame) -> DataFrame:
    """G1: stock per product and warehouse with its value."""
    p = products.select("product_id", "product_name", "category", "unit_price")
    w = warehouse.select("warehouse_id", "warehouse_name")
    # both dimensions arrive partitioned by their key (a dedupe window)
    return (split_join(split_join(inventory, p, "product_id"), w, "warehouse_id")
            .select("inventory_id", "product_id", "product_name", "category",
                    "warehouse_id", "warehouse_name", "quantity_on_hand", "reorder_threshold",
                    (F.col("quantity_on_hand") * F.col("unit_price")).alias("stock_value"),
                    "last_updated"))


def low_stock_alerts(snapshot: DataFrame) -> DataFrame:
    """G2: rows below their reorder threshold, with the shortfall.

    The filter only reads fact columns, so Catalyst pushes it below both
    dimension joins of the snapshot, down to the inventory scan.
    """
    return (snapshot.where(F.col("quantity_on_hand") < F.col("reorder_threshold"))
            .withColumn("shortfall", F.col("reorder_threshold") - F.col("quantity_on_hand")))


def supplier_performance(orders: DataFrame, supplier_history: DataFrame,
                         drop_null_groups: bool = False, count_unknown: bool = False) -> DataFrame:
    """G3: delivery performance per supplier.

    Orders are aggregated per supplier first, then joined to the current
    supplier rows (one per supplier).  Orders of suppliers without a
    current row stay as their own group with NULL name (D6).  An order
    without a delivery date has NULL delay: it is left out of both
    averages instead of counting as late (D7); ``count_unknown=True`` adds
    their number as ``orders_unknown_delay``.  ``drop_null_groups=True`` drops groups with a
    NULL supplier id or name, as a pandas group-by would.
    """
    on_time = (F.col("delay_days") <= 0).cast("int")
    per = orders.groupBy("supplier_id").agg(
        F.count("order_id").alias("total_orders"),
        F.avg("delay_days").alias("_avg_delay"),
        F.avg(on_time).alias("_on_time"),
        F.sum("quantity_ordered").cast("bigint").alias("total_qty_ordered"),
        F.count_if(F.col("delay_days").isNull()).alias("orders_unknown_delay"),
    )
    cur = current_suppliers(supplier_history).select("supplier_id", "supplier_name", "rating")
    out = per.join(cur, "supplier_id", "inner" if drop_null_groups else "left")
    if drop_null_groups:
        out = out.where(F.col("supplier_id").isNotNull() & F.col("supplier_name").isNotNull())
    return (out
            .select("supplier_id", "supplier_name", "total_orders",
                    F.round("_avg_delay", 2).alias("avg_delay_days"),
                    F.round(F.col("_on_time") * 100, 1).alias("on_time_pct"),
                    "total_qty_ordered",
                    F.col("rating").alias("current_rating"),
                    *(["orders_unknown_delay"] if count_unknown else [])))


def sales_by_product_month(sales: DataFrame) -> DataFrame:
    """Sales summed per product and month; G4 and G6 can both start from it (``_n`` counts the sales)."""
    return sales.groupBy("product_id", month_bucket("sale_date").alias("month")).agg(
        F.sum("quantity_sold").cast("bigint").alias("_units"),
        F.sum(F.col("revenue").cast("decimal(18,2)")).alias("_revenue"),
        F.count("sale_id").alias("_n"),
    )


def _totals(sales: DataFrame, units: str, n: str):
    """Units, revenue and sales of ``sales`` or of ``sales_by_product_month``."""
    if "_n" in sales.columns:
        return (F.sum("_units").cast("bigint").alias(units), F.sum("_revenue").alias("_revenue"), F.sum("_n").cast("bigint").alias(n))
    return (F.sum("quantity_sold").cast("bigint").alias(units),
            F.sum(F.col("revenue").cast("decimal(18,2)")).alias("_revenue"), F.count("sale_id").alias(n))


def movement_base(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(*_totals(sales, "total_units_sold", "num_sales_txns"))


def movement_cuts(base: DataFrame, approx: bool = False):
    """Cuts at the 0.66 and 0.33 quantile of units sold."""
    return quantile_values(base, "total_units_sold", [FAST_QUANTILE, SLOW_QUANTILE], "approx" if approx else "exact")


def product_movement(sales: DataFrame, products: DataFrame, approx: bool = False) -> DataFrame:
    """G4: units, revenue and a fast/medium/slow class per product.

    Exact interpolated quantiles by default (the reference's golden
    values); ``approx=True`` uses a 0.01 rank-error sketch instead.  The
    totals per product are written, so the sales are read once.
    """
    base = written(movement_base(sales), "movement_base")
    fast, slow = movement_cuts(base, approx)
    p = products.select("product_id", "product_name", "category")
    return (base.join(p, "product_id", "left")
            .select("product_id", "product_name", "category", "total_units_sold",
                    F.col("_revenue").cast("double").alias("total_revenue"),
                    "num_sales_txns",
                    classify_movement("total_units_sold", fast, slow).alias("movement_category")))


def sales_summary(sales: DataFrame, products: DataFrame, warehouse: DataFrame,
                  drop_null_groups: bool = False) -> DataFrame:
    """G5: units and revenue per warehouse and category.

    Sales are pre-aggregated per (product, warehouse) before the product
    join, so the join sees one row per pair instead of one per sale.
    Sales of unknown products or warehouses form NULL groups (D6) unless
    ``drop_null_groups=True``.
    """
    pre = sales.groupBy("product_id", "warehouse_id").agg(
        F.sum("quantity_sold").cast("bigint").alias("_units"),
        F.sum(F.col("revenue").cast("decimal(18,2)")).alias("_revenue"),
        F.count("sale_id").alias("_n"),
    )
    p = products.select("product_id", "category")
    w = warehouse.select("warehouse_id", "warehouse_name")
    joined = pre.join(p, "product_id", "left").join(w, "warehouse_id", "left")
    if drop_null_groups:
        joined = joined.dropna(subset=["warehouse_id", "warehouse_name", "category"])
    return (joined.groupBy("warehouse_id", "warehouse_name", "category")
            .agg(F.sum("_units").cast("bigint").alias("total_units_sold"),
                 F.sum("_revenue").cast("double").alias("total_revenue"),
                 F.sum("_n").cast("bigint").alias("num_transactions")))


def sales_trends(sales: DataFrame) -> DataFrame:
    """G6: monthly totals and growth against the previous present month.

    Months without sales are not filled in (the previous *present* month
    is used, as in the reference).  A sale without a date makes a NULL
    month row that is kept but not chained (D15); growth after a zero
    month is NULL (D14).  The unpartitioned window runs on one row per
    month, after aggregation.
    """
    month = F.col("month") if "_n" in sales.columns else month_bucket("sale_date").alias("month")
    base = sales.groupBy(month).agg(*_totals(sales, "total_units_sold", "num_transactions"))
    w = Window.partitionBy(F.col("month").isNull()).orderBy("month")
    prev = F.lag("_revenue").over(w)
    return base.select(
        "month", "total_units_sold",
        F.col("_revenue").cast("double").alias("total_revenue"),
        "num_transactions",
        F.when(F.col("month").isNotNull(), growth_pct("_revenue", prev)).alias("revenue_growth_pct"),
    )
