"""Golden values of the reference, reproduced from inline copies of its raw feeds."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

import golden_rows as G
from fixtures import (PRODUCTS_CSV, SCD2_GOLDEN, SUPPLIERS_DAY1_CSV, SUPPLIERS_DAY2_CSV, TRENDS_GOLDEN,
                      write_text)
from godown.operators import clean, scd2
from godown.plans import dashboard, gold
from godown.schemas import (INGEST_TS, INVENTORY, ORDERS, PRODUCTS, SOURCE_FILE, SUPPLIER_HISTORY_COLUMNS, SUPPLIER_TRACKED,
                            SUPPLIERS, WAREHOUSE)
from godown.sources import bronze

RUN = dt.datetime(2026, 7, 2, 6, 0)


def _suppliers(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/suppliers_2026-06-01.csv", SUPPLIERS_DAY1_CSV)
    write_text(f"{tmp_dir}/raw/suppliers_2026-07-01.csv", SUPPLIERS_DAY2_CSV)
    paths = [f"{tmp_dir}/raw/suppliers_2026-06-01.csv", f"{tmp_dir}/raw/suppliers_2026-07-01.csv"]
    return bronze.read_feed(spark, SUPPLIERS, paths, ingest_ts=RUN)


def test_bronze_lineage_and_quoted_commas(spark, tmp_dir):
    df = _suppliers(spark, tmp_dir)
    rows = df.orderBy(SOURCE_FILE, "supplier_id").collect()
    assert len(rows) == 9
    assert rows[0]["address"] == "Sitapura, Jaipur"           # quoted comma kept in one field
    assert {r[SOURCE_FILE] for r in rows} == {"suppliers_2026-06-01.csv", "suppliers_2026-07-01.csv"}
    assert {r[INGEST_TS] for r in rows} == {RUN}


def test_silver_products_golden(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/products.csv", PRODUCTS_CSV)
    raw = bronze.read_feed(spark, PRODUCTS, f"{tmp_dir}/raw/products.csv", ingest_ts=RUN)
    out = clean.clean_products(raw)
    rows = {r["product_id"]: r for r in out.collect()}
    assert len(rows) == 25                                     # duplicate P004 removed
    assert rows["P008"]["unit_price"] == 2216.955              # exact interpolated median
    assert rows["P001"]["unit_price"] == 173.8
    assert out.columns == ["product_id", "product_name", "category", "unit_price", "supplier_id"]


def test_silver_products_approx_median_is_an_existing_value(spark, tmp_dir):
    write_text(f"{tmp_dir}/raw/products.csv", PRODUCTS_CSV)
    raw = bronze.read_feed(spark, PRODUCTS, f"{tmp_dir}/raw/products.csv", ingest_ts=RUN)
    p8 = clean.clean_products(raw, approx=True).where("product_id = 'P008'").first()
    assert p8["unit_price"] == 1882.4                          # D1: what the notebook path gives


def test_scd2_replay_golden(spark, tmp_dir):
    typed = clean.try_types(_suppliers(spark, tmp_dir), SUPPLIERS.casts)
    snaps = clean.dedupe_rows(typed).drop(SOURCE_FILE, INGEST_TS)
    hist = scd2.scd2_replay(snaps, "supplier_id", SUPPLIER_TRACKED, "source_date",
                            columns=SUPPLIER_HISTORY_COLUMNS)
    got = sorted((r.supplier_id, r.address, r.rating, str(r.effective_start),
                  None if r.effective_end is None else str(r.effective_end), r.is_current)
                 for r in hist.collect())
    assert got == sorted(SCD2_GOLDEN)
    assert scd2.current_count(hist).first().asDict() == {"versions": 7, "current_versions": 5}


def test_scd2_merge_golden(spark, tmp_dir):
    typed = clean.try_types(_suppliers(spark, tmp_dir), SUPPLIERS.casts).drop(SOURCE_FILE, INGEST_TS)
    d1 = typed.where(F.col("source_date") == F.lit(dt.date(2026, 6, 1)))
    d2 = typed.where(F.col("source_date") == F.lit(dt.date(2026, 7, 1)))
    hist = scd2.first_load(d1, "supplier_id", "source_date", columns=SUPPLIER_HISTORY_COLUMNS)
    hist = scd2.scd2_merge(hist, d2, "supplier_id", SUPPLIER_TRACKED, "source_date")
    got = sorted((r.supplier_id, r.address, r.rating, str(r.effective_start),
                  None if r.effective_end is None else str(r.effective_end), r.is_current)
                 for r in hist.collect())
    assert got == sorted(SCD2_GOLDEN)


def _feed(spark, tmp_dir, spec, text):
    write_text(f"{tmp_dir}/raw/{spec.name}.csv", text)
    return bronze.read_feed(spark, spec, f"{tmp_dir}/raw/{spec.name}.csv", ingest_ts=RUN)


def _golden_layers(spark, tmp_dir):
    from godown.plans.pipeline import BronzeLayers
    feeds = {"products": (PRODUCTS, PRODUCTS_CSV), "warehouse": (WAREHOUSE, G.WAREHOUSE_CSV),
             "inventory": (INVENTORY, G.INVENTORY_CSV), "orders": (ORDERS, G.ORDERS_CSV)}
    return BronzeLayers(spark, {n: _feed(spark, tmp_dir, spec, text) for n, (spec, text) in feeds.items()}
                        | {"suppliers": _suppliers(spark, tmp_dir)})


def test_stock_golden(spark, tmp_dir):
    """G1, G2, K1, K5 from the published stock rows: value per warehouse and in all, alerts, largest shortfalls."""
    snapshot = _golden_layers(spark, tmp_dir).inventory_snapshot
    assert snapshot.count() == 75
    assert {r.warehouse_name: r.stock_value_lakh for r in dashboard.stock_by_warehouse(snapshot).collect()} == G.STOCK_LAKH
    assert round(snapshot.agg(F.sum("stock_value")).first()[0] / 100_000, 1) == G.STOCK_LAKH_TOTAL
    alerts = gold.ordered(gold.low_stock_alerts(snapshot), "low_stock_alerts").collect()
    assert len(alerts) == 19
    assert [(r.inventory_id, r.quantity_on_hand, r.reorder_threshold, r.shortfall) for r in alerts[:2]] == G.TOP_SHORTFALLS


def test_supplier_performance_golden(spark, tmp_dir):
    """G3 from the published purchase orders and snapshots, in the published order."""
    got = gold.ordered(_golden_layers(spark, tmp_dir).supplier_performance, "supplier_performance").collect()
    assert [(r.supplier_name, r.total_orders, r.avg_delay_days, r.on_time_pct, r.total_qty_ordered, r.current_rating)
            for r in got] == G.SUPPLIER_PERFORMANCE


def test_movement_classes_golden(spark, tmp_dir):
    """G4: cuts and classes of the published units per product, 9 fast, 8 medium, 8 slow."""
    sales = spark.createDataFrame([(p, u, 1.0, i) for i, (p, u, _) in enumerate(G.MOVEMENT)],
                                  "product_id string, quantity_sold int, revenue double, sale_id int")
    got = gold.product_movement(sales, clean.clean_products(_feed(spark, tmp_dir, PRODUCTS, PRODUCTS_CSV))).collect()
    assert {r.product_id: r.movement_category for r in got} == {p: c for p, _, c in G.MOVEMENT}
    assert sorted(Counter(r.movement_category for r in got).values()) == [8, 8, 9]


def test_sales_trends_growth_golden(spark):
    # growth between the published month totals: one sale per month carries them
    rows = [(i, f"{m}-15", u, f"{rev:.2f}") for i, (m, u, rev, _n, _g) in enumerate(TRENDS_GOLDEN)]
    df = spark.createDataFrame(rows, "sale_id int, sale_date string, quantity_sold int, revenue string") \
        .select("sale_id", F.to_date("sale_date").alias("sale_date"), "quantity_sold",
                F.col("revenue").cast("decimal(18,2)").alias("revenue"))
    got = {r.month: (r.total_units_sold, r.total_revenue, r.revenue_growth_pct)
           for r in gold.sales_trends(df).collect()}
    for m, u, rev, _n, g in TRENDS_GOLDEN:
        assert got[m] == (u, rev, g)
