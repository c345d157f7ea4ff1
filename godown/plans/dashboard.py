"""Dashboard data sets K1-K9 and the warehouse x category matrix (7.16).

Only the data behind the dashboard is built (no HTML).  KPI scalars are
one-row aggregates folded into one row (no cross join, no driver round
trip); top-n lists are ``orderBy().limit()`` (a per-task top-n, then one
small merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.functions.exprs import (DELAY_FORMAT, FAST, PCT_FORMAT, RATING_FORMAT, first_word, lakh,
                                    month_label, pill_class, short_movement, sign_class, signed_pct_label)


def _arg_best(value: str, measure: str, tie: str):
    """Value of the row with the largest measure; smallest ``tie`` wins ties; NULL measures skipped."""
    rank = F.when(F.col(measure).isNotNull(), F.struct((-F.col(measure)).alias("m"), F.col(tie).alias("t")))
    return F.min_by(value, rank)


def kpi_scalars(snapshot: DataFrame, performance: DataFrame, movement: DataFrame, trends: DataFrame) -> DataFrame:
    """K1: the fourteen headline numbers in one row.

    One one-row aggregate per Gold table; the four rows are stacked (union
    by name, each KPI column filled in exactly one of them) and folded
    into one row with ``max``.  One job, no cross join, nothing passes
    through the driver.  The low-stock count is counted on the snapshot:
    the alert table is the snapshot filtered by stock < threshold.
    """
    low = F.col("quantity_on_hand") < F.col("reorder_threshold")
    parts = [
        snapshot.agg(lakh(F.sum("stock_value")).alias("total_stock_value_l"),
                     F.count_if(low).alias("low_stock_count"),
                     F.count(F.lit(1)).alias("inventory_rows"),
                     F.count_distinct("warehouse_id").alias("warehouse_count")),
        performance.agg(F.round(F.avg("on_time_pct"), 1).alias("avg_on_time_pct"),
                        F.sum("total_orders").alias("total_orders"),
                        _arg_best("supplier_name", "on_time_pct", "supplier_id").alias("best_supplier_name"),
                        _arg_best("on_time_pct", "on_time_pct", "supplier_id").alias("best_supplier_pct"),
                        _arg_best("supplier_name", "current_rating", "supplier_id").alias("top_rated_name"),
                        _arg_best("current_rating", "current_rating", "supplier_id").alias("top_rated_score")),
        trends.agg(lakh(F.sum("total_revenue")).alias("revenue_l"),
                   F.sum("total_units_sold").alias("units"),
                   F.round(F.max_by("revenue_growth_pct", "month"), 1).alias("latest_growth_pct")),
        movement.agg(F.count_if(F.col("movement_category") == FAST).alias("fast_moving_count")),
    ]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in KPI_COLUMNS])


KPI_COLUMNS = ("total_stock_value_l", "low_stock_count", "inventory_rows", "warehouse_count",
               "avg_on_time_pct", "total_orders", "best_supplier_name", "best_supplier_pct",
               "top_rated_name", "top_rated_score", "revenue_l", "units", "latest_growth_pct",
               "fast_moving_count")


def top_shortfalls(alerts: DataFrame, n: int = 6) -> DataFrame:
    """K2: the n largest shortfalls."""
    return (alerts.orderBy(F.desc("shortfall"), F.asc("inventory_id")).limit(n)
            .select("inventory_id", "product_name", "warehouse_name", "quantity_on_hand",
                    "reorder_threshold", "shortfall"))


def _fmt(fmt: str, c: str):
    return F.when(F.col(c).isNotNull(), F.format_string(fmt, F.col(c)))


def supplier_scorecard(performance: DataFrame) -> DataFrame:
    """K3: every supplier, best on-time share first, with display labels."""
    return (performance
            .select("supplier_id", "supplier_name", "total_orders",
                    _fmt(DELAY_FORMAT, "avg_delay_days").alias("avg_delay_label"),
                    _fmt(PCT_FORMAT, "on_time_pct").alias("on_time_label"),
                    _fmt(RATING_FORMAT, "current_rating").alias("rating_label"),
                    "on_time_pct")
            .orderBy(F.desc_nulls_last("on_time_pct"), F.asc("supplier_id")))


def top_movers(movement: DataFrame, n: int = 5) -> DataFrame:
    """K4: the n best-selling products with a short class label."""
    return (movement.orderBy(F.desc("total_units_sold"), F.asc("product_id")).limit(n)
            .select("product_id", "product_name", "category", "total_units_sold",
                    short_movement("movement_category").alias("movement_label"),
                    pill_class("movement_category").alias("pill_class")))


def stock_by_warehouse(snapshot: DataFrame) -> DataFrame:
    """K5: stock value per warehouse in lakh (ascending in the chart)."""
    return (snapshot.groupBy("warehouse_name").agg(F.sum("stock_value").alias("_v"))
            .orderBy("_v", "warehouse_name")
            .select("warehouse_name", lakh("_v").alias("stock_value_lakh")))


def ontime_series(performance: DataFrame) -> DataFrame:
    """K6: on-time share per supplier, labelled by the first word of the name."""
    return (performance.orderBy(F.desc_nulls_last("on_time_pct"), "supplier_id")
            .select("supplier_id", first_word("supplier_name").alias("label"),
                    F.round("on_time_pct", 1).alias("on_time_pct")))


def revenue_series(trends: DataFrame) -> DataFrame:
    """K7: monthly revenue in lakh with a 'Mon YYYY' label."""
    return (trends.orderBy(F.asc_nulls_first("month"))
            .select("month", month_label("month").alias("label"), lakh("total_revenue").alias("revenue_lakh")))


def delay_vs_rating(performance: DataFrame) -> DataFrame:
    """K8: scatter pairs of average delay and current rating."""
    return performance.select("supplier_id", "supplier_name", "avg_delay_days", "current_rating")


def trend_growth(trends: DataFrame) -> DataFrame:
    """K9: revenue with growth as a second series, plus its display label."""
    g = F.round("revenue_growth_pct", 1)
    return trends.select("month", "total_revenue", "revenue_growth_pct",
                         signed_pct_label(g).alias("growth_label"), sign_class(g).alias("growth_class"))


def sales_matrix(summary: DataFrame, categories) -> DataFrame:
    """7.16: revenue matrix warehouse x category with declared categories.

    Declaring the pivot values avoids the extra job that collects the
    distinct categories to the driver.  Revenue of unknown or undeclared
    categories is in ``revenue_other``, so each row adds up to the summary.
    """
    cats = list(categories)
    known = F.col("category").isin(cats)
    of = [F.sum(F.when(F.col("category") == c, F.col("total_revenue"))).alias(f"revenue_{c.lower()}") for c in cats]
    other = F.sum(F.when(~F.coalesce(known, F.lit(False)), F.col("total_revenue"))).alias("revenue_other")
    return summary.groupBy("warehouse_id", "warehouse_name").agg(*of, other)
