"""Registered dashboard data sets (K1 - K9, 7.16, 9.4, 10.x)."""

from __future__ import annotations

from godown.oracle import rnd
from godown.plans import dashboard
from godown.plans.pipeline import Layers
from godown.plans.q_gold import gold_sql
from godown.plans.registry import query

# The part types of the driver's tables, declared as the
# pivot columns of the warehouse x category matrix.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

_LAKH = "CAST(1e5 AS DOUBLE)"

_KPI_SQL = gold_sql(f"""
SELECT
  (SELECT {rnd(f'sum(stock_value) / {_LAKH}', 1)} FROM g_snapshot) AS total_stock_value_l,
  (SELECT count(*) FROM g_alerts) AS low_stock_count,
  (SELECT count(*) FROM g_snapshot) AS inventory_rows,
  (SELECT count(DISTINCT warehouse_id) FROM g_snapshot) AS warehouse_count,
  (SELECT {rnd('avg(on_time_pct)', 1)} FROM g_supplier_perf) AS avg_on_time_pct,
  (SELECT CAST(sum(total_orders) AS BIGINT) FROM g_supplier_perf) AS total_orders,
  (SELECT supplier_name FROM g_supplier_perf WHERE on_time_pct IS NOT NULL
     ORDER BY on_time_pct DESC, supplier_id LIMIT 1) AS best_supplier_name,
  (SELECT on_time_pct FROM g_supplier_perf WHERE on_time_pct IS NOT NULL
     ORDER BY on_time_pct DESC, supplier_id LIMIT 1) AS best_supplier_pct,
  (SELECT supplier_name FROM g_supplier_perf WHERE current_rating IS NOT NULL
     ORDER BY current_rating DESC, supplier_id LIMIT 1) AS top_rated_name,
  (SELECT current_rating FROM g_supplier_perf WHERE current_rating IS NOT NULL
     ORDER BY current_rating DESC, supplier_id LIMIT 1) AS top_rated_score,
  (SELECT {rnd(f'sum(total_revenue) / {_LAKH}', 1)} FROM g_trends) AS revenue_l,
  (SELECT CAST(sum(total_units_sold) AS BIGINT) FROM g_trends) AS units,
  (SELECT {rnd('revenue_growth_pct', 1)} FROM g_trends WHERE month IS NOT NULL
     ORDER BY month DESC LIMIT 1) AS latest_growth_pct,
  (SELECT count(*) FILTER (WHERE movement_category = 'Fast-moving') FROM g_movement) AS fast_moving_count
""")


@query("kpi_scalars", _KPI_SQL)
def q_kpi_scalars(spark, sf_dir):
    """K1, 7.10 - 7.13, 2.10, 10.4."""
    L = Layers(spark, sf_dir)
    return dashboard.kpi_scalars(L.inventory_snapshot, L.supplier_performance, *L.movement_and_trends())


@query("top_shortfalls", gold_sql("""
SELECT inventory_id, product_name, warehouse_name, quantity_on_hand, reorder_threshold, shortfall
FROM g_alerts ORDER BY shortfall DESC, inventory_id LIMIT 6
"""))
def q_top_shortfalls(spark, sf_dir):
    """K2, 9.4."""
    return dashboard.top_shortfalls(Layers(spark, sf_dir).low_stock_alerts)


@query("supplier_scorecard", gold_sql("""
SELECT supplier_id, supplier_name, total_orders, printf('%.2fd', avg_delay_days) AS avg_delay_label,
       printf('%.1f%%', on_time_pct) AS on_time_label, printf('%.1f', current_rating) AS rating_label,
       on_time_pct
FROM g_supplier_perf
"""))
def q_supplier_scorecard(spark, sf_dir):
    """K3, 9.1."""
    return dashboard.supplier_scorecard(Layers(spark, sf_dir).supplier_performance)


@query("top_movers", gold_sql("""
SELECT product_id, product_name, category, total_units_sold,
       replace(movement_category, '-moving', '') AS movement_label,
       CASE movement_category WHEN 'Fast-moving' THEN 'fast' WHEN 'Medium-moving' THEN 'medium'
            WHEN 'Slow-moving' THEN 'slow' ELSE '' END AS pill_class
FROM g_movement ORDER BY total_units_sold DESC, product_id LIMIT 5
"""))
def q_top_movers(spark, sf_dir):
    """K4, 9.4, 10.8, 10.9."""
    return dashboard.top_movers(Layers(spark, sf_dir).product_movement)


@query("stock_by_warehouse", gold_sql(f"""
SELECT warehouse_name, {rnd(f'sum(stock_value) / {_LAKH}', 1)} AS stock_value_lakh
FROM g_snapshot GROUP BY warehouse_name
"""))
def q_stock_by_warehouse(spark, sf_dir):
    """K5, 7.14, 10.4."""
    return dashboard.stock_by_warehouse(Layers(spark, sf_dir).inventory_snapshot)


@query("ontime_series", gold_sql(f"""
SELECT supplier_id, split_part(supplier_name, ' ', 1) AS label, {rnd('on_time_pct', 1)} AS on_time_pct
FROM g_supplier_perf
"""))
def q_ontime_series(spark, sf_dir):
    """K6, 10.7."""
    return dashboard.ontime_series(Layers(spark, sf_dir).supplier_performance)


@query("revenue_series", gold_sql(f"""
SELECT month,
       CASE WHEN month IS NULL THEN NULL ELSE
         concat_ws(' ', ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']
                        [CAST(substr(month, 6, 2) AS INTEGER)], substr(month, 1, 4)) END AS label,
       {rnd(f'total_revenue / {_LAKH}', 1)} AS revenue_lakh
FROM g_trends
"""))
def q_revenue_series(spark, sf_dir):
    """K7, 10.6, 10.4."""
    return dashboard.revenue_series(Layers(spark, sf_dir).sales_trends)


@query("delay_vs_rating", gold_sql(
    "SELECT supplier_id, supplier_name, avg_delay_days, current_rating FROM g_supplier_perf"))
def q_delay_vs_rating(spark, sf_dir):
    """K8."""
    return dashboard.delay_vs_rating(Layers(spark, sf_dir).supplier_performance)


@query("trend_growth", gold_sql(f"""
SELECT month, total_revenue, revenue_growth_pct,
       CASE WHEN g IS NULL THEN 'N/A' ELSE printf('%+.1f%%', g) END AS growth_label,
       CASE WHEN g IS NULL THEN '' WHEN g < 0 THEN 'danger' ELSE 'good' END AS growth_class
FROM (SELECT *, {rnd('revenue_growth_pct', 1)} AS g FROM g_trends)
"""))
def q_trend_growth(spark, sf_dir):
    """K9, 10.10."""
    return dashboard.trend_growth(Layers(spark, sf_dir).sales_trends)


_MATRIX_COLS = ", ".join(
    f"sum(total_revenue) FILTER (WHERE category = '{c}') AS revenue_{c.lower()}" for c in CATEGORIES)
_MATRIX_COLS += (", sum(total_revenue) FILTER (WHERE category IS NULL OR category NOT IN ("
                 + ", ".join(f"'{c}'" for c in CATEGORIES) + ")) AS revenue_other")


@query("sales_matrix", gold_sql(f"""
SELECT warehouse_id, warehouse_name, {_MATRIX_COLS} FROM g_summary GROUP BY warehouse_id, warehouse_name
"""))
def q_sales_matrix(spark, sf_dir):
    """7.16: revenue by warehouse x category."""
    return dashboard.sales_matrix(Layers(spark, sf_dir).sales_summary, CATEGORIES)
