"""The materialised pipeline: written layers, versioning, quarantine, streams."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from godown.plans.pipeline import Layers
from godown.plans.run import run_pipeline
from godown.schemas import SALES
from godown.sources import bronze, feeds, store
from godown.streaming import ingest


def test_run_twice(spark, tmp_dir):
    first = {r.table_name: r.row_count for r in run_pipeline(spark, SF_SMALL, tmp_dir).collect()}
    L = Layers(spark, SF_SMALL)
    assert first["gold.product_movement"] == L.product_movement.count()
    assert first["silver.suppliers_scd2"] == L.suppliers_scd2.count()
    q = spark.read.parquet(f"{tmp_dir}/silver/sales_quarantine").count()
    assert first["silver.sales"] + q == L.sales.count()          # passed + quarantined = input
    second = {r.table_name: r.row_count for r in run_pipeline(spark, SF_SMALL, tmp_dir).collect()}
    assert second == first
    assert spark.read.parquet(f"{tmp_dir}/silver/sales_quarantine").count() == q   # no pile-up
    assert store.VersionedTable(spark, f"{tmp_dir}/gold/sales_trends").current_version() == 2
    assert store.table_exists(spark, "gold.product_movement")
    assert spark.table("gold.product_movement").count() == first["gold.product_movement"]
    assert spark.sql("SELECT count(*) FROM silver.suppliers_scd2 WHERE is_current").first()[0] > 0


def test_versioned_self_overwrite(spark, tmp_dir):
    t = store.VersionedTable(spark, f"{tmp_dir}/t")
    assert not t.exists()
    t.write(spark.range(10))
    t.write(t.read().where("id % 2 = 0"))                          # read v1, write v2
    assert t.current_version() == 2 and t.read().count() == 5 and t.read(1).count() == 10


def test_stream_equals_batch_and_rerun_adds_nothing(spark, tmp_dir):
    raw = feeds.raw_sales(spark, SF_SMALL).select(*SALES.columns)
    bronze.write_csv(raw, f"{tmp_dir}/landing/drop1")
    n1 = ingest.stream_feed(spark, SALES.raw_schema(), f"{tmp_dir}/landing/*", f"{tmp_dir}/out", f"{tmp_dir}/ck")
    n2 = ingest.stream_feed(spark, SALES.raw_schema(), f"{tmp_dir}/landing/*", f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert n1 == raw.count() and n2 == 0
    streamed = spark.read.parquet(f"{tmp_dir}/out").select(*SALES.columns)
    batch = bronze.read_feed(spark, SALES, f"{tmp_dir}/landing/*").select(*SALES.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert spark.read.parquet(f"{tmp_dir}/out").where(F.col("_source_file").isNull()).count() == 0


def test_stream_scd2_equals_replay(spark):
    got = E.queries()["bronze_stream_scd2"](spark, SF_SMALL)
    want = Layers(spark, SF_SMALL).suppliers_scd2
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_scd2_with_a_late_snapshot_equals_replay(spark, tmp_dir):
    # snapshots arrive 1996, 2000, then the late 1998 file; the late file must be spliced in
    import datetime as dt
    from godown.operators import clean
    from godown.schemas import INGEST_TS, LINEAGE, SOURCE_FILE, SUPPLIER_HISTORY_COLUMNS, SUPPLIER_TRACKED, SUPPLIERS
    raw = feeds.raw_supplier_snapshots(spark, SF_SMALL).drop(*LINEAGE)
    casts = {**SUPPLIERS.casts, "supplier_id": "bigint"}
    for i, d in enumerate([feeds.SNAPSHOT_DATES[0], feeds.SNAPSHOT_DATES[2], feeds.SNAPSHOT_DATES[1]]):
        bronze.write_csv(raw.where(F.col("source_date") == F.lit(d)), f"{tmp_dir}/landing/drop{i}")
        history = ingest.stream_scd2(spark, SUPPLIERS.raw_schema(), f"{tmp_dir}/landing/*", f"{tmp_dir}/suppliers",
                                     f"{tmp_dir}/ck", "supplier_id", SUPPLIER_TRACKED, "source_date", casts,
                                     SUPPLIER_HISTORY_COLUMNS)
    got = history.read()
    want = Layers(spark, SF_SMALL).suppliers_scd2
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_rows_delivered_again_come_from_the_first_files(spark, tmp_dir):
    from godown.plans import q_sources
    from godown.schemas import FEEDS
    L = Layers(spark, SF_SMALL)
    for f in ("sales", "orders", "inventory", "products"):
        rows = getattr(L, f).select(*FEEDS[f].columns)
        q_sources._deliver(rows, f"{tmp_dir}/{f}")
        again = q_sources._part(spark, rows, f, f"{tmp_dir}/{f}")
        text = [F.col(c).cast("string") for c in FEEDS[f].columns]
        want = rows.where(F.pmod(F.xxhash64(*FEEDS[f].key), F.lit(3)) == 0).select(*text)
        got = again.select(*text)
        assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        if f != "products":                                       # nothing is cleaned, so shuffled, a second time
            assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()


def test_alerts_are_taken_from_the_written_snapshot(spark, tmp_dir, monkeypatch):
    from godown.plans import gold
    alerts, plans = gold.low_stock_alerts, []
    monkeypatch.setattr(gold, "low_stock_alerts", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or alerts(df))
    run_pipeline(spark, SF_SMALL, tmp_dir)
    assert len(plans) == 1 and "Join" not in plans[0]
    got = store.VersionedTable(spark, f"{tmp_dir}/gold/low_stock_alerts").read().drop(store.PLACE)
    snapshot = store.VersionedTable(spark, f"{tmp_dir}/gold/inventory_snapshot").read().drop(store.PLACE)
    want = alerts(snapshot)
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_tables_are_written_compressed(spark, tmp_dir):
    import glob
    import pyarrow.parquet as pq
    table = store.VersionedTable(spark, f"{tmp_dir}/t")
    table.write(spark.range(1000).selectExpr("id", "cast(id as string) AS text"))
    store.append(table.read(), f"{tmp_dir}/a")
    files = glob.glob(f"{tmp_dir}/t/v=1/*.parquet") + glob.glob(f"{tmp_dir}/a/*.parquet")
    assert {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in files} == {"ZSTD"}
    assert spark.read.parquet(f"{tmp_dir}/a").exceptAll(table.read()).count() == 0


def _shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(i).name() for i in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_job_splits_scans_that_sort_and_leaves_no_shuffle_files(spark, tmp_dir, monkeypatch):
    from godown.session import JOB_CONF, SORTED_SCANS
    seen, write = {}, store.VersionedTable.write
    conf = lambda: {k: spark.conf.get(k, None) for k in (*JOB_CONF, *SORTED_SCANS)}
    monkeypatch.setattr(store.VersionedTable, "write", lambda self, *a, **k: seen.update({self.root.split("/")[-2]: conf()}) or write(self, *a, **k))
    outside = conf()
    before = _shuffle_files(spark)
    run_pipeline(spark, SF_SMALL, tmp_dir)
    assert _shuffle_files(spark) <= before                        # they go with each table, whatever the garbage collector does
    assert seen["silver"] == outside | JOB_CONF | SORTED_SCANS    # small tasks where rows are sorted
    assert seen["gold"] == outside | JOB_CONF and conf() == outside


def test_settings_leave_what_the_caller_has_set(spark):
    from godown.session import settings
    mine, other = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.set(mine, "5m")
    try:
        with settings(spark, {mine: "1m", other: "2"}):
            assert (spark.conf.get(mine), spark.conf.get(other)) == ("5m", "2")
        assert spark.conf.get(mine) == "5m" and spark.conf.get(other, None) is None
    finally:
        spark.conf.unset(mine)


def test_feeds_stream_side_by_side(spark, tmp_dir, monkeypatch):
    from threading import Barrier
    meet = Barrier(3, timeout=30)                                 # broken if they come one after the other
    monkeypatch.setattr(ingest, "stream_feed", lambda spark, schema, in_dir, *a: meet.wait() * 0 + len(in_dir))
    assert ingest.stream_feeds(spark, {"a": (None, "x"), "b": (None, "xx"), "c": (None, "xxx")}, tmp_dir) == {"a": 1, "b": 2, "c": 3}


def test_deliveries_are_compressed_quickly(spark, tmp_dir):
    import glob
    import os
    from godown.plans import q_sources
    rows = feeds.raw_sales(spark, SF_SMALL).select(*SALES.columns).coalesce(1)
    q_sources._deliver_all(spark, {"sales": rows}, f"{tmp_dir}/{{}}/quick")
    bronze.write_csv(rows, f"{tmp_dir}/sales/usual", compression="gzip")
    size = {k: sum(map(os.path.getsize, glob.glob(f"{tmp_dir}/sales/{k}/*.gz"))) for k in ("quick", "usual")}
    assert size["usual"] < size["quick"] < 1.2 * size["usual"]
    quick, usual = (bronze.read_feed(spark, SALES, f"{tmp_dir}/sales/{k}").select(*SALES.columns) for k in size)
    assert quick.exceptAll(usual).count() == 0 and usual.exceptAll(quick).count() == 0
