"""Registered source / sink / streaming queries (1.x, 11.x) and the price lookup (6.7).

The ingestion queries first drop feed files derived from the driver's
tables into a fresh folder under ``spark.checkpoint.dir`` (that is the
"upstream system"), then ingest them the way a scheduled job would, and
return what landed in Bronze.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from godown.oracle import LINEAGE_ORDER, TS_RUN, first_per, rnd, with_ctes
from godown.operators import clean, quality
from godown.operators.joins import split_join
from godown.plans.pipeline import Layers
from godown.plans.q_scd2 import IRREGULAR, IRREGULAR_SQL, deliveries
from godown.plans.registry import query
from godown.schemas import (FEEDS, INGEST_TS, LINEAGE, ORDERS, SALES, SOURCE_FILE, SUPPLIER_HISTORY_COLUMNS,
                            SUPPLIER_TRACKED, SUPPLIERS)
from godown.session import JOB_CONF, SORTED_SCANS, in_parallel, scratch_path, settings
from godown.sources import bronze, feeds, store
from godown.streaming import ingest

SPLIT_DATE = dt.date(1998, 1, 1)   # fixed value: first vs second delivery of a feed


def _business(df, spec):
    return df.select(*spec.columns)


# ---- 1.1 / 1.5 / 1.6: batch CSV ingestion of a multi-file feed -------------
_SUP_TYPED = {**SUPPLIERS.casts, "supplier_id": "bigint"}


@query("bronze_batch_lineage", with_ctes(f"""
SELECT supplier_id, supplier_name, address, contact_email, rating, source_date,
       _source_file AS feed, {TS_RUN} AS _ingest_timestamp
FROM raw_supplier_snapshots
"""))
def q_bronze_batch_lineage(spark, sf_dir):
    """Supplier snapshot files (one folder per file) read in one scan with lineage.

    ``feed`` is the landing folder of each row; ``_source_file`` (the
    physical part file) is dropped from the result because Spark names
    part files with a random id.
    """
    root = scratch_path(spark, "landing_suppliers")
    raw = feeds.raw_supplier_snapshots(spark, sf_dir)
    files = raw.drop(INGEST_TS).withColumnRenamed(SOURCE_FILE, "feed")
    files.write.partitionBy("feed").option("header", True).csv(root)
    df = bronze.read_feed(spark, SUPPLIERS, root, ingest_ts=feeds.RUN_TS)
    typed = clean.try_types(df, _SUP_TYPED)
    return typed.select(*SUPPLIERS.columns, "feed", INGEST_TS)


# ---- 1.2 / 11.1 - 11.3: incremental file stream, run to completion --------
_SALES_TYPED = {**SALES.casts, "sale_id": "bigint", "product_id": "bigint", "warehouse_id": "int"}


@query("bronze_stream_available_now", with_ctes(
    "SELECT sale_id, product_id, warehouse_id, sale_date, quantity_sold, unit_price, "
    "CAST(revenue AS DOUBLE) AS revenue FROM raw_sales"))
def q_bronze_stream_available_now(spark, sf_dir):
    """Two deliveries of the sales feed, three availableNow runs (the last finds nothing)."""
    root = scratch_path(spark, "stream_sales")
    raw = _business(feeds.raw_sales(spark, sf_dir), SALES)
    first = F.col("sale_date") < F.lit(SPLIT_DATE)
    landing, out, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint"
    bronze.write_csv(raw.where(first), f"{landing}/drop1")
    runs = [ingest.stream_feed(spark, SALES.raw_schema(), f"{landing}/*", out, ckpt)]
    bronze.write_csv(raw.where(~first | F.col("sale_date").isNull()), f"{landing}/drop2")
    runs.append(ingest.stream_feed(spark, SALES.raw_schema(), f"{landing}/*", out, ckpt))
    runs.append(ingest.stream_feed(spark, SALES.raw_schema(), f"{landing}/*", out, ckpt))
    if runs[2] != 0:
        raise RuntimeError(f"re-run ingested {runs[2]} rows again")
    landed = ingest.read_landed(spark, out)
    return _business(clean.try_types(landed, _SALES_TYPED), SALES)


# ---- columns by name, files of any age ---------------------------------------
_RAW_SALES = ("SELECT sale_id, product_id, warehouse_id, sale_date, quantity_sold, unit_price, "
              "CAST(revenue AS DOUBLE) AS revenue FROM raw_sales")


def _two_deliveries(spark, sf_dir, root, second, out_columns, age_days=None):
    """The sales feed in two deliveries, the second one changed by ``second``; what has landed, typed."""
    raw = _business(feeds.raw_sales(spark, sf_dir), SALES)
    first = F.col("sale_date") < F.lit(SPLIT_DATE)
    landing, out, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint"
    bronze.write_csv(raw.where(first), f"{landing}/drop1")
    ingest.stream_feed(spark, SALES.raw_schema(), f"{landing}/*", out, ckpt)
    bronze.write_csv(second(raw.where(~first | F.col("sale_date").isNull())), f"{landing}/drop2")
    if age_days:
        set_file_age(spark, f"{landing}/drop2", age_days)
    ingest.stream_feed(spark, SALES.raw_schema(), f"{landing}/*", out, ckpt)
    return clean.try_types(ingest.read_landed(spark, out), _SALES_TYPED).select(*out_columns)


def set_file_age(spark, folder: str, days: int) -> None:
    """Date the files of a folder back, as an upstream system that delivers late would have them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(path):
        fs.setTimes(f.getPath(), f.getModificationTime() - days * 86_400_000, -1)


@query("bronze_header_order", with_ctes(_RAW_SALES))
def q_bronze_header_order(spark, sf_dir):
    """1.1: the second delivery has its columns in another order; they land by name."""
    return _two_deliveries(spark, sf_dir, scratch_path(spark, "header_order"),
                           lambda df: df.select(*reversed(SALES.columns)), SALES.columns)


@query("bronze_old_file", with_ctes(_RAW_SALES))
def q_bronze_old_file(spark, sf_dir):
    """1.2: files of the second delivery are nine days older than the newest one read so far; they land all the same."""
    return _two_deliveries(spark, sf_dir, scratch_path(spark, "old_file"), lambda df: df, SALES.columns, age_days=9)


# ---- 1.3 / 1.4: additive schema evolution ----------------------------------
@query("bronze_schema_evolution", with_ctes(f"""
SELECT sale_id, product_id, warehouse_id, sale_date, quantity_sold, unit_price, CAST(revenue AS DOUBLE) AS revenue,
       CASE WHEN sale_date < DATE '{SPLIT_DATE}' THEN NULL ELSE 'ch-' || (product_id % 7) END AS channel
FROM raw_sales
"""))
def q_bronze_schema_evolution(spark, sf_dir):
    """1.4 on the stream: the second delivery has a new column in the middle; it is NULL in what landed before."""
    def with_channel(df):
        cols = list(SALES.columns)
        channel = F.concat(F.lit("ch-"), (F.col("product_id") % 7).cast("string")).alias("channel")
        return df.select(*cols[:3], channel, *cols[3:])

    return _two_deliveries(spark, sf_dir, scratch_path(spark, "evolving_sales"), with_channel, (*SALES.columns, "channel"))


@query("bronze_evolving_tables", with_ctes(f"""
SELECT order_id, product_id, supplier_id, order_date, expected_delivery, actual_delivery, quantity_ordered,
       CASE WHEN order_date < DATE '{SPLIT_DATE}' THEN NULL ELSE status END AS status
FROM raw_orders
"""))
def q_bronze_evolving_tables(spark, sf_dir):
    """1.4 in a batch read: orders delivered first without, later with the ``status`` column."""
    root = scratch_path(spark, "evolving_orders")
    raw = _business(feeds.raw_orders(spark, sf_dir), ORDERS)
    first = F.col("order_date") < F.lit(SPLIT_DATE)
    store.overwrite(raw.where(first).drop("status"), f"{root}/part1")
    store.overwrite(raw.where(~first), f"{root}/part2")
    return bronze.read_evolving(spark, [f"{root}/part1", f"{root}/part2"]).select(*ORDERS.columns)


# ---- the job over CSV feeds, from Bronze on ----------------------------------
_FEED_TABLES = {"products": "products", "warehouse": "warehouse", "inventory": "inventory", "orders": "orders",
                "sales": "sales", "suppliers": "supplier_snapshots"}


#: Feeds of numbers, dates and fixed words: one row per line of their files, whatever the tables hold.
_PLAIN_FEEDS = ("inventory", "orders", "sales")


#: Half the time of gzip's usual level, files a sixteenth larger.
_QUICK = {"zlib.compress.level": "FOUR"}


def _deliver(rows, path: str) -> None:
    bronze.write_csv(rows, path, compression="gzip", options=_QUICK)


def _deliver_all(spark, rows: dict, path: str) -> None:
    """Feed -> rows; ``path`` names a feed's folder."""
    with settings(spark, JOB_CONF), settings(spark, SORTED_SCANS):
        in_parallel(lambda f: _deliver(rows[f], path.format(f)), rows, 3)


def _part(spark, rows, feed: str, delivered: str):
    """The rows of ``feed`` that are delivered again: a third of the keys; large feeds from the files delivered first."""
    key = FEEDS[feed].key
    again = rows if feed not in _PLAIN_FEEDS else spark.read.option("header", True).csv(delivered)
    typed = [F.col(c).cast(rows.schema[c].dataType) for c in key]
    return again.where(F.pmod(F.xxhash64(*typed), F.lit(3)) == 0)


def _job(spark, sf_dir, name: str):
    """Cleaned rows as CSV feeds, delivered, then delivered again in part; the job runs after each delivery."""
    from godown.plans.run import run_pipeline
    root = scratch_path(spark, name)
    L = Layers(spark, sf_dir)
    dirs = {f: f"{root}/in/{f}/*" for f in _FEED_TABLES}
    rows = {f: getattr(L, t).select(*FEEDS[f].columns) for f, t in _FEED_TABLES.items()}
    _deliver_all(spark, rows, f"{root}/in/{{}}/drop1")
    first = run_pipeline(spark, None, f"{root}/lake", feed_dirs=dirs)
    _deliver_all(spark, {f: _part(spark, df, f, f"{root}/in/{f}/drop1") for f, df in rows.items()}, f"{root}/in/{{}}/drop2")
    again = run_pipeline(spark, None, f"{root}/lake", feed_dirs=dirs)
    return f"{root}/lake", first, again


@query("pipeline_silver_sales", with_ctes(
    "SELECT sale_id, product_id, warehouse_id, sale_date, quantity_sold, unit_price, revenue FROM s_sales WHERE revenue >= 0"))
def q_pipeline_silver_sales(spark, sf_dir):
    """1.9 - 1.13, 4.8, 11.3: Silver sales of the job over CSV feeds after two runs, read from its catalog table's data."""
    root, _, _ = _job(spark, sf_dir, "job_sales")
    t = store.VersionedTable(spark, f"{root}/silver/sales")
    rows = t.read().where("_dq_passed = 'true'").select(*SALES.columns)
    return clean.try_types(rows, _SALES_TYPED)


@query("pipeline_quarantine", with_ctes("""
SELECT 'sales' AS feed, CAST(sale_id AS VARCHAR) AS business_key, 'revenue_non_negative' AS failed FROM s_sales WHERE revenue IS NULL OR revenue < 0
UNION ALL
SELECT 'inventory', CAST(inventory_id AS VARCHAR), 'quantity_on_hand_non_negative' FROM s_inventory WHERE quantity_on_hand < 0
UNION ALL
SELECT 'orders', CAST(order_id AS VARCHAR), 'expected_after_order' FROM s_orders
WHERE expected_delivery IS NULL OR order_date IS NULL OR expected_delivery < order_date
"""))
def q_pipeline_quarantine(spark, sf_dir):
    """4.8: the quarantine tables after two runs over overlapping deliveries; each failure is there once."""
    root, _, _ = _job(spark, sf_dir, "job_quarantine")
    parts = [spark.read.parquet(f"{root}/silver/{f}_quarantine")
             .select(F.lit(f).alias("feed"), F.col(FEEDS[f].key[0]).cast("string").alias("business_key"), F.col("_dq_failed_rule").alias("failed"))
             for f in ("sales", "inventory", "orders")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("pipeline_counts", with_ctes("""
SELECT 'silver.products' AS table_name, count(*) AS row_count FROM s_products WHERE unit_price > 0
UNION ALL SELECT 'silver.warehouse', count(*) FROM s_warehouse
UNION ALL SELECT 'silver.inventory', count(*) FROM s_inventory WHERE quantity_on_hand >= 0 AND reorder_threshold >= 0
UNION ALL SELECT 'silver.orders', count(*) FROM s_orders WHERE expected_delivery >= order_date
UNION ALL SELECT 'silver.sales', count(*) FROM s_sales WHERE quantity_sold > 0 AND revenue >= 0
UNION ALL SELECT 'silver.suppliers_scd2', count(*) FROM s_suppliers_scd2
"""))
def q_pipeline_counts(spark, sf_dir):
    """1.14: the audit of the written Silver tables after two runs."""
    return _job(spark, sf_dir, "job_counts")[2].where("table_name LIKE 'silver.%'")


# ---- 3.1 / 3.2: unreadable text from the feed to Silver ---------------------------
# Fixed rules on keys: which cleaned rows are sent with text that can't be read.
_DIRTY = {
    "sales": (("sale_date", "sale_id % 17 = 3", "31.12.99"), ("quantity_sold", "sale_id % 23 = 7", "many"), ("revenue", "sale_id % 19 = 5", "1,234.50")),
    "orders": (("expected_delivery", "order_id % 29 = 1", "2024-13-45"), ("quantity_ordered", "order_id % 31 = 4", "12 pcs")),
    "products": (("unit_price", "product_id % 37 = 2", "free"),),
}


def _dirty_job(spark, sf_dir, name: str) -> str:
    """Bronze and Silver of the job over feeds with unreadable text; the lake's folder."""
    from godown.plans import run
    from godown.plans.pipeline import BronzeLayers
    root = scratch_path(spark, name)
    L = Layers(spark, sf_dir)
    for f, t in _FEED_TABLES.items():
        rows = L.supplier_snapshots if f == "suppliers" else getattr(L, t)
        texts = {c: F.when(F.expr(rule), F.lit(text)).otherwise(F.col(c).cast("string")) for c, rule, text in _DIRTY.get(f, ())}
        _deliver(rows.select(*[texts.get(c, F.col(c)).alias(c) for c in FEEDS[f].columns]), f"{root}/in/{f}/drop1")
    landed = run.write_bronze(spark, {f: f"{root}/in/{f}/*" for f in _FEED_TABLES}, f"{root}/lake")
    run.write_silver(spark, BronzeLayers(spark, landed), f"{root}/lake", deliveries=True)
    return f"{root}/lake"


@query("pipeline_dirty_sales", with_ctes("""
SELECT sale_id, product_id, warehouse_id, CASE WHEN sale_id % 17 <> 3 THEN sale_date END AS sale_date, quantity_sold, unit_price,
       CASE WHEN sale_id % 19 <> 5 THEN revenue END AS revenue,
       CASE WHEN sale_id % 19 = 5 OR revenue < 0 THEN 'revenue_non_negative' END AS failed
FROM s_sales WHERE sale_id % 23 <> 7
"""))
def q_pipeline_dirty_sales(spark, sf_dir):
    """3.1, 3.2, 3.4: unreadable dates and numbers are NULL in Silver, an unreadable quantity counts as 0 and drops the sale, an unreadable revenue fails its rule."""
    t = store.VersionedTable(spark, f"{_dirty_job(spark, sf_dir, 'job_dirty')}/silver/sales")
    typed = clean.try_types(t.read().drop(*LINEAGE), _SALES_TYPED)
    return typed.select(*SALES.columns, F.col(quality.FAILED).alias("failed"))


def _rescued_sql(feed: str, source: str) -> str:
    parts = " || ".join(f"CASE WHEN {rule} THEN ',\"{c}\":\"{text}\"' ELSE '' END" for c, rule, text in _DIRTY[feed])
    key = FEEDS[feed].key[0]
    return (f"SELECT '{feed}' AS feed, CAST({key} AS VARCHAR) AS business_key, '{{' || substr(t, 2) || '}}' AS rescued "
            f"FROM (SELECT {key}, {parts} AS t FROM {source}) WHERE t <> ''")


@query("pipeline_rescued", with_ctes(" UNION ALL ".join(_rescued_sql(f, f"s_{f}") for f in ("sales", "orders", "products"))))
def q_pipeline_rescued(spark, sf_dir):
    """3.1, 3.2: every text that could not be read, by business key, from the ``*_rescued`` tables of the job."""
    lake = _dirty_job(spark, sf_dir, "job_rescued")
    parts = [store.VersionedTable(spark, f"{lake}/silver/{f}_rescued").read()
             .select(F.lit(f).alias("feed"), F.col(FEEDS[f].key[0]).alias("business_key"), F.col(clean.RESCUED).alias("rescued"))
             for f in (*_DIRTY, "warehouse", "inventory")]
    return reduce(DataFrame.unionByName, parts)


# ---- 1.3 / 1.8: inferred schema, dates in another format ---------------------------
@query("bronze_inferred_schema", with_ctes(
    "SELECT order_id, product_id, supplier_id, order_date, expected_delivery, actual_delivery, quantity_ordered, status FROM raw_orders"))
def q_bronze_inferred_schema(spark, sf_dir):
    """1.3: types inferred from the first delivery and stored; the second run, over a delivery without open orders, reuses them."""
    root = scratch_path(spark, "inferred_orders")
    raw = _business(feeds.raw_orders(spark, sf_dir), ORDERS)
    late = F.col("order_date") >= F.lit(SPLIT_DATE)
    for i, rows in enumerate((raw.where(~late | (F.col("status") == "Open")), raw.where(late & (F.col("status") != "Open")))):
        bronze.write_csv(rows, f"{root}/landing/drop{i}")
        ingest.stream_feed(spark, None, f"{root}/landing/*", f"{root}/bronze", f"{root}/_checkpoint")
    landed = ingest.read_landed(spark, f"{root}/bronze")
    kinds = dict(landed.dtypes)
    if (kinds["order_date"], kinds["status"]) != ("date", "string") or kinds["quantity_ordered"] != "int":
        raise RuntimeError(f"inferred {kinds}")
    ids = [F.col(c).cast("bigint").alias(c) for c in ("order_id", "product_id", "supplier_id")]
    return landed.select(*ids, *[c for c in ORDERS.columns if c not in ("order_id", "product_id", "supplier_id")])


@query("bronze_date_format", with_ctes("""
SELECT sale_id, product_id, warehouse_id, CASE WHEN sale_id % 41 <> 6 THEN sale_date END AS sale_date, quantity_sold FROM raw_sales
"""))
def q_bronze_date_format(spark, sf_dir):
    """1.8: dates parsed while reading, by a given format; one in another format is NULL and the row stays."""
    root = scratch_path(spark, "dated_sales")
    text = F.when(F.col("sale_id") % 41 == 6, F.date_format("sale_date", "yyyy.MM")).otherwise(F.date_format("sale_date", "dd/MM/yyyy"))
    rows = feeds.raw_sales(spark, sf_dir).withColumn("sale_date", text)
    columns = ["sale_id", "product_id", "warehouse_id", "sale_date", "quantity_sold"]
    bronze.write_csv(rows.select(*columns), root)
    schema = T.StructType.fromDDL("sale_id bigint, product_id bigint, warehouse_id int, sale_date date, quantity_sold int")
    return bronze.read_feed(spark, None, root, schema=schema, date_format="dd/MM/yyyy").select(*columns)


# ---- 11.4 / 3.3: supplier snapshots streamed into the SCD2 history ---------------
def _streamed(spark, name: str, deliveries) -> ingest.History:
    """Each delivery dropped as CSV and merged by its own run of the stream."""
    root = scratch_path(spark, name)
    history = None
    for i, rows in enumerate(deliveries):
        bronze.write_csv(rows, f"{root}/landing/drop{i}")
        history = ingest.stream_scd2(spark, SUPPLIERS.raw_schema(), f"{root}/landing/*", f"{root}/suppliers", f"{root}/_checkpoint",
                                     "supplier_id", SUPPLIER_TRACKED, "source_date", _SUP_TYPED, SUPPLIER_HISTORY_COLUMNS, buckets=16)
    return history


def _by_day(spark, sf_dir, order=(0, 1, 2)):
    raw = feeds.raw_supplier_snapshots(spark, sf_dir).drop(*LINEAGE)
    return [raw.where(F.col("source_date") == F.lit(feeds.SNAPSHOT_DATES[i])) for i in order]


@query("bronze_stream_scd2", with_ctes("SELECT * FROM s_suppliers_scd2"))
def q_bronze_stream_scd2(spark, sf_dir):
    """Each snapshot delivery merged by foreachBatch; equals the full replay."""
    return _streamed(spark, "stream_suppliers", _by_day(spark, sf_dir)).read()


@query("bronze_stream_scd2_late", with_ctes("SELECT * FROM s_suppliers_scd2"))
def q_bronze_stream_scd2_late(spark, sf_dir):
    """11.4 with a late delivery: the middle snapshot file arrives last and is spliced in."""
    return _streamed(spark, "stream_suppliers_late", _by_day(spark, sf_dir, (0, 2, 1))).read()


def _text_deliveries(spark, sf_dir):
    """The irregular deliveries of ``scd2_merge_irregular`` as an upstream system sends them: dates as text, some unreadable."""
    rows = deliveries(spark, sf_dir).select(*SUPPLIERS.columns, "delivery")
    return [rows.where(F.col("delivery") == i).drop("delivery") for i in range(4)]


@query("bronze_stream_scd2_irregular", IRREGULAR_SQL)
def q_bronze_stream_scd2_irregular(spark, sf_dir):
    """11.4 over NULL keys, unreadable dates, same-day corrections and late rows; equals the replay of the dated rows."""
    return _streamed(spark, "stream_suppliers_irregular", _text_deliveries(spark, sf_dir)).read()


_QUARANTINE_SQL = with_ctes("""
SELECT supplier_id, supplier_name, address, contact_email, rating, 'snapshot_date_valid' AS _dq_failed_rule,
       '{"source_date":"01/02/xx"}' AS _rescued
FROM irr WHERE source_date IS NULL
""", IRREGULAR)


@query("bronze_stream_scd2_quarantine", _QUARANTINE_SQL)
def q_bronze_stream_scd2_quarantine(spark, sf_dir):
    """3.3 in the stream: rows without a readable date are set aside with the text that could not be read."""
    bad = _streamed(spark, "stream_suppliers_quarantine", _text_deliveries(spark, sf_dir)).quarantine()
    return bad.select(*SUPPLIER_HISTORY_COLUMNS, quality.FAILED, clean.RESCUED)


@query("pipeline_suppliers_quarantine", _QUARANTINE_SQL)
def q_pipeline_suppliers_quarantine(spark, sf_dir):
    """3.3 in the job: ``suppliers_quarantine`` after two runs over deliveries of which the second repeats the first."""
    from godown.plans.run import run_pipeline
    root = scratch_path(spark, "job_suppliers")
    L = Layers(spark, sf_dir)
    dirs = {f: f"{root}/in/{f}/*" for f in _FEED_TABLES}
    _deliver_all(spark, {f: getattr(L, t).select(*FEEDS[f].columns) for f, t in _FEED_TABLES.items() if f != "suppliers"},
                 f"{root}/in/{{}}/drop1")
    first = _text_deliveries(spark, sf_dir)
    for i, part in enumerate((first[0].unionByName(first[1]), first[1].unionByName(first[2]).unionByName(first[3]))):
        _deliver(part, f"{root}/in/suppliers/drop{i}")
        run_pipeline(spark, None, f"{root}/lake", feed_dirs=dirs)
    bad = spark.read.parquet(f"{root}/lake/silver/suppliers_quarantine")
    return clean.try_types(bad, _SUP_TYPED).select(*SUPPLIER_HISTORY_COLUMNS, quality.FAILED, clean.RESCUED)


# ---- 1.14: row-count audit --------------------------------------------------
_COUNTED = ("products", "warehouse", "inventory", "orders", "sales", "suppliers_scd2",
            "inventory_snapshot", "low_stock_alerts", "supplier_performance", "product_movement",
            "sales_summary", "sales_trends")
_COUNT_CTE = {"products": "s_products", "warehouse": "s_warehouse", "inventory": "s_inventory",
              "orders": "s_orders", "sales": "s_sales", "suppliers_scd2": "s_suppliers_scd2",
              "inventory_snapshot": "g_snapshot", "low_stock_alerts": "g_alerts",
              "supplier_performance": "g_supplier_perf", "product_movement": "g_movement",
              "sales_summary": "g_summary", "sales_trends": "g_trends"}


def _table_counts_sql():
    from godown.plans.q_gold import gold_sql
    return gold_sql(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {_COUNT_CTE[t]}" for t in _COUNTED))


@query("table_counts", _table_counts_sql())
def q_table_counts(spark, sf_dir):
    """Rows per Silver and Gold table, counted on the tables that the job has written."""
    from godown.plans.run import run_pipeline
    audit = run_pipeline(spark, sf_dir, scratch_path(spark, "audit"), quality_checks=False)
    return audit.select(F.regexp_replace("table_name", "^(silver|gold)[.]", "").alias("table_name"), "row_count")


# ---- 6.7 / 10.11 - 10.14: price lookup with a default, labels and picks -----
# Fixed values of the price lookup: warehouse codes, first date, day span,
# quantity range and the price of unknown products.
GEN_WAREHOUSES = ("WH01", "WH02", "WH03")
GEN_START = dt.date(2026, 5, 1)
GEN_DAYS = 72
GEN_MAX_QTY = 20
GEN_DEFAULT_PRICE = 100.0


@query("line_price_lookup", with_ctes(f"""
SELECT printf('SALE%08d', i) AS sale_id, g.product_id,
       ['WH01', 'WH02', 'WH03'][CAST((i * 7 + 3) % 3 AS INTEGER) + 1] AS warehouse_id,
       DATE '{GEN_START}' + CAST((i * 13) % {GEN_DAYS} AS INTEGER) AS sale_date,
       CAST(1 + (i * 17) % {GEN_MAX_QTY} AS INTEGER) AS quantity_sold,
       coalesce(p.unit_price, {GEN_DEFAULT_PRICE}) AS unit_price,
       {rnd(f'CAST(1 + (i * 17) % {GEN_MAX_QTY} AS INTEGER) * coalesce(p.unit_price, {GEN_DEFAULT_PRICE})', 2)}
         AS revenue
FROM (SELECT l_orderkey * 10 + l_linenumber AS i, l_partkey AS product_id FROM lineitem) g
LEFT JOIN gen_products p ON g.product_id = p.product_id
""", {"gen_products": first_per("raw_products", ["product_id"],
                                LINEAGE_ORDER + ["product_name", "category", "unit_price", "supplier_id"])}))
def q_line_price_lookup(spark, sf_dir):
    """Every order line priced from the product list (a default for unknown ones), with a padded label and picks by id."""
    li = feeds.table(spark, sf_dir, "lineitem")
    products = clean.dedupe(feeds.raw_products(spark, sf_dir), ["product_id"]).select("product_id", "unit_price")
    i = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    qty = (F.lit(1) + F.pmod(F.col("_i") * 17, F.lit(GEN_MAX_QTY))).cast("int")
    price = F.coalesce(F.col("unit_price"), F.lit(GEN_DEFAULT_PRICE))
    gen = li.select(i.alias("_i"), F.col("l_partkey").alias("product_id"))
    # the deduplicated products arrive partitioned by product_id (see operators/joins.py)
    return (split_join(gen, products, "product_id", "left")
            .select(F.format_string("SALE%08d", F.col("_i")).alias("sale_id"),
                    "product_id",
                    F.element_at(F.array(*[F.lit(w) for w in GEN_WAREHOUSES]),
                                 (F.pmod(F.col("_i") * 7 + 3, F.lit(3)) + 1).cast("int")).alias("warehouse_id"),
                    F.date_add(F.lit(GEN_START), F.pmod(F.col("_i") * 13, F.lit(GEN_DAYS)).cast("int"))
                     .alias("sale_date"),
                    qty.alias("quantity_sold"),
                    price.alias("unit_price"),
                    F.round(qty * price, 2).alias("revenue")))
