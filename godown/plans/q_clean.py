"""Registered Silver cleaning queries (2.x, 3.x, 1.15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from godown.operators import clean
from godown.oracle import LINEAGE_ORDER, first_per, with_ctes
from godown.plans.pipeline import Layers
from godown.plans.registry import query
from godown.schemas import FEEDS, PRODUCTS
from godown.session import written


@query("clean_products", with_ctes("SELECT * FROM s_products"))
def q_clean_products(spark, sf_dir):
    return Layers(spark, sf_dir).products


@query("clean_products_category_median", with_ctes("SELECT * FROM s_products_catmed"))
def q_clean_products_category_median(spark, sf_dir):
    return clean.clean_products(Layers(spark, sf_dir).raw("products"), category_median=True)


@query("clean_products_approx_median", with_ctes(
    "SELECT count(*) AS products, TRUE AS one_existing_price, TRUE AS within_rank_error FROM s_products"))
def q_clean_products_approx_median(spark, sf_dir):
    """D1 option: is the imputed price an existing one, within rank error 0.01 of the median?  Over all products."""
    raw = Layers(spark, sf_dir).raw("products")
    known = clean.clean_feed(raw, PRODUCTS).select("product_id", F.col("unit_price").alias("known"))
    both = written(clean.clean_products(raw, approx=True).join(known, "product_id"), "approx_median")
    filled = F.when(F.col("known").isNull(), F.col("unit_price"))
    cut = both.agg(F.max(filled)).scalar()
    n = F.count("known")
    return both.agg(
        F.count(F.lit(1)).alias("products"),
        ((F.min(filled).eqNullSafe(F.max(filled))) & (F.count_if(F.col("known") == cut) > 0)).alias("one_existing_price"),
        ((F.count_if(F.col("known") < cut) <= n * 0.51) & (F.count_if(F.col("known") <= cut) >= n * 0.49)).alias("within_rank_error"))


@query("clean_products_banded_median", with_ctes("SELECT * FROM s_products"))
def q_clean_products_banded_median(spark, sf_dir):
    """3.7 with every category sharing one group: the grouped bracket method must give the global median."""
    L = Layers(spark, sf_dir)
    df = clean.clean_feed(L.raw("products"), PRODUCTS).withColumn("_all", F.when(F.col("product_id") < 0, F.lit("x")))
    return clean.impute_median(df, "unit_price", by="_all").drop("_all")


@query("clean_warehouse", with_ctes("SELECT * FROM s_warehouse"))
def q_clean_warehouse(spark, sf_dir):
    return Layers(spark, sf_dir).warehouse


@query("clean_inventory", with_ctes("SELECT * FROM s_inventory"))
def q_clean_inventory(spark, sf_dir):
    return Layers(spark, sf_dir).inventory


@query("clean_orders", with_ctes("SELECT * FROM s_orders"))
def q_clean_orders(spark, sf_dir):
    return Layers(spark, sf_dir).orders


@query("clean_sales", with_ctes("SELECT * FROM s_sales"))
def q_clean_sales(spark, sf_dir):
    return Layers(spark, sf_dir).sales


# 3.5 on its own: first raw product row per key, re-sent rows lose (D13).
@query("dedup_by_key", with_ctes(first_per("raw_products", ["product_id"],
                                           LINEAGE_ORDER + ["product_name", "category", "unit_price",
                                                            "supplier_id"])))
def q_dedup_by_key(spark, sf_dir):
    return clean.dedupe(Layers(spark, sf_dir).raw("products"), ["product_id"])


# 3.6 on its own: supplier snapshot rows deduplicated on business columns (D4).
@query("dedup_all_columns", with_ctes("SELECT * FROM sup_rows_q",
                                      {"sup_rows_q": first_per(
                                          "raw_supplier_snapshots",
                                          ["supplier_id", "supplier_name", "address", "contact_email",
                                           "rating", "source_date"], LINEAGE_ORDER)}))
def q_dedup_all_columns(spark, sf_dir):
    return clean.dedupe_rows(Layers(spark, sf_dir).raw("supplier_snapshots"))


_STEP_FEEDS = ("products", "warehouse", "inventory", "orders", "sales")

# What the steps mean, written out for SQL: (zero-filled, required, filter, key).
_STEPS = {
    "products": ("FALSE", "product_id IS NOT NULL AND product_name IS NOT NULL", "TRUE", "product_id"),
    "warehouse": ("FALSE", "TRUE", "TRUE", "warehouse_id"),
    "inventory": ("quantity_on_hand IS NULL OR reorder_threshold IS NULL", "product_id IS NOT NULL AND warehouse_id IS NOT NULL",
                  "TRUE", "inventory_id"),
    "orders": ("quantity_ordered IS NULL", "order_id IS NOT NULL AND supplier_id IS NOT NULL AND product_id IS NOT NULL",
               "TRUE", "order_id"),
    "sales": ("quantity_sold IS NULL", "sale_id IS NOT NULL AND product_id IS NOT NULL AND warehouse_id IS NOT NULL",
              "coalesce(quantity_sold, 0) > 0", "sale_id"),
}


def _step_sql(name: str) -> str:
    zf, req, flt, k = _STEPS[name]
    return (f"SELECT '{name}' AS feed, count(*) AS rows_in, count(*) FILTER (WHERE {zf}) AS zero_filled, "
            f"count(*) FILTER (WHERE {req}) AS after_required, "
            f"count(*) FILTER (WHERE {req} AND {flt}) AS after_filter, "
            f"count(DISTINCT CASE WHEN {req} AND {flt} THEN {k} END) AS rows_out FROM raw_{name}")


@query("step_counts", with_ctes(" UNION ALL ".join(_step_sql(n) for n in _STEP_FEEDS)))
def q_step_counts(spark, sf_dir):
    """1.15: before/after counts of every cleaning step, one aggregate per feed."""
    L = Layers(spark, sf_dir)
    parts = [clean.step_counts(L.raw(n), FEEDS[n]) for n in _STEP_FEEDS]
    return reduce(lambda a, b: a.unionByName(b), parts)
