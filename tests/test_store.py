"""Counts with the write and ordered tables."""

import pytest
from pyspark.sql import functions as F

from godown.plans import gold
from godown.sources import store


def test_counts_come_from_the_writing_job(spark, tmp_dir):
    """No second job reads the table: the counts are observed in the write and kept with the commit."""
    t = store.VersionedTable(spark, f"{tmp_dir}/t")
    assert t.counts() == {}
    t.write(spark.range(1000, numPartitions=7), counts={"odd": F.count_if(F.col("id") % 2 == 1)})
    assert t.counts() == {"rows": 1000, "odd": 500}
    t.write(spark.range(0))
    assert t.counts() == {"rows": 0} and t.counts(1)["rows"] == 1000


def test_audit_reads_no_table(spark, tmp_dir, monkeypatch):
    """4.7 / 1.14: passed and quarantined rows of a checked table equal what is on disk, without reading it."""
    from conftest import SF_SMALL
    from godown.plans import run
    from godown.plans.pipeline import Layers
    silver = run._write_one_silver(spark, Layers(spark, SF_SMALL), tmp_dir, "sales", True)
    on_disk = silver.read().count()
    monkeypatch.setattr(run.SilverTable, "read", lambda self: pytest.fail("read for a count"))
    assert silver.rows() == on_disk > 0
    counts = silver.table.counts()
    assert counts["passed"] + counts["quarantined"] == counts["rows"]
    assert counts["quarantined"] == spark.read.parquet(f"{tmp_dir}/silver/sales_quarantine").count()


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_ranks_of_an_ordered_table(spark, tmp_dir, rows):
    """Many parts, ties broken by the key, NULLs where the order says; the rank is the place in the global order."""
    df = spark.range(rows).select("id", F.when(F.col("id") % 7 > 0, F.col("id") * 31 % 100).alias("v"))
    by = [F.desc_nulls_last("v"), F.asc("id")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.overwrite(store.ordered(df, by), f"{tmp_dir}/o{rows}")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(f"{tmp_dir}/o{rows}")
    got = sorted((r["rank"], r["id"]) for r in store.ranked(back).collect())
    want = [(i + 1, r["id"]) for i, r in enumerate(df.orderBy(*by).collect())]
    assert got == want
    if rows == 5000:
        assert back.select(F.shiftright(store.PLACE, store.PLACE_BITS)).distinct().count() > 1


def test_gold_is_written_in_its_order(spark, tmp_dir):
    df = spark.createDataFrame([(2, 5), (1, 9), (3, None), (0, 5)], "product_id int, total_units_sold int")
    t = store.VersionedTable(spark, f"{tmp_dir}/g")
    t.write(store.ordered(df, gold.order_of("product_movement")))
    assert [r["product_id"] for r in store.ranked(t.read()).orderBy("rank").collect()] == [1, 0, 2, 3]
