"""The bucketed history: cost follows the batch, repeated deliveries change nothing, bad dates go to quarantine."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from godown.operators import clean, scd2
from godown.sources import bronze, store
from godown.streaming import ingest

D = dt.date
COLS = ("k", "name", "v")


def history(spark, root, buckets=8):
    return ingest.History(spark, root, "k", ("v",), "d", {"k": "bigint", "v": "int", "d": "date"}, COLS, buckets=buckets)


def delivery(spark, rows, file="f.csv"):
    """Rows as they land: text with lineage."""
    df = spark.createDataFrame([tuple(None if x is None else str(x) for x in r) for r in rows], "k string, name string, v string, d string")
    return df.withColumn("_source_file", F.lit(file)).withColumn("_ingest_timestamp", F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz"))


def folders(root, version):
    path = f"{root}/history/v={version}"
    return sorted(f for f in os.listdir(path) if f.startswith("_bucket="))


def rows_of(df):
    return sorted(map(str, df.select("k", "name", "v", "effective_start", "effective_end", "is_current").collect()))


def test_one_percent_of_keys_rewrites_only_their_buckets(spark, tmp_dir):
    """File listing: version 2 holds the buckets of the batch's keys; every other file is as it was."""
    h = history(spark, tmp_dir, buckets=256)
    h.merge(delivery(spark, [(k, "n", 1, "2026-01-01") for k in range(800)]), 0)
    before = {f: os.path.getmtime(f"{tmp_dir}/history/v=1/{f}") for f in folders(tmp_dir, 1)}
    assert len(before) > 200
    keys = list(range(5, 13))
    h.merge(delivery(spark, [(k, "n", 2, "2026-02-01") for k in keys]), 1)
    touched = {r[0] for r in spark.createDataFrame([(k,) for k in keys], "k long").select(h.store.bucket_of(["k"])).collect()}
    assert folders(tmp_dir, 2) == sorted(f"_bucket={b}" for b in touched)
    assert {f: os.path.getmtime(f"{tmp_dir}/history/v=1/{f}") for f in folders(tmp_dir, 1)} == before
    held = h.store.holders()
    assert {b for b, v in held.items() if v == 2} == touched and len(held) == len(before)
    got = h.read()
    assert got.count() == 808 and got.where("is_current and v = 2").count() == 8
    # the old version stays readable
    assert h.store.read(got.schema, version=1).count() == 800


def test_a_batch_reads_only_its_buckets(spark, tmp_dir):
    h = history(spark, tmp_dir, buckets=16)
    h.merge(delivery(spark, [(k, "n", 1, "2026-01-01") for k in range(200)]), 0)
    files = [f for p in h.store.paths() for f in [p]]
    part = h.versions([3])
    assert len(files) == 16 and {f.rsplit("/", 2)[-2] for f in part.inputFiles()} == {"_bucket=3"}


@pytest.mark.parametrize("seed", range(4))
def test_deliveries_in_any_order_equal_the_replay(spark, tmp_dir, seed):
    """NULL keys, several days and rows of a day in one delivery, corrections, late and unchanged snapshots."""
    r = random.Random(seed)
    rows = [(r.choice([None, 1, 2, 3, 4]), r.choice("ab"), r.choice([None, 1, 2]), D(2026, 1, r.randrange(1, 9))) for _ in range(60)]
    h = history(spark, tmp_dir, buckets=4)
    for i in range(4):
        h.merge(delivery(spark, rows[i::4]), i)
    whole = spark.createDataFrame(rows, "k long, name string, v int, d date")
    assert rows_of(h.read()) == rows_of(scd2.scd2_replay(whole, "k", ("v",), "d", columns=COLS))


def test_an_unchanged_snapshot_counts_as_seen(spark, tmp_dir):
    """A(1st), A again (3rd), then B of the 2nd arrives late: A must come back on the 3rd."""
    h = history(spark, tmp_dir)
    for i, row in enumerate([(1, "n", 10, "2026-01-01"), (1, "n", 10, "2026-01-03"), (1, "n", 20, "2026-01-02")]):
        h.merge(delivery(spark, [row]), i)
    got = [(r.v, r.effective_start.day) for r in h.read().orderBy("effective_start").collect()]
    assert got == [(10, 1), (20, 2), (10, 3)]
    assert {r[0] for r in h.versions().select(scd2.LAST_SEEN).distinct().collect()} == {D(2026, 1, 3)}


def test_a_repeated_delivery_changes_nothing(spark, tmp_dir):
    h = history(spark, tmp_dir)
    one, two = [(1, "n", 1, "2026-01-01"), (2, "n", 1, "no date")], [(1, "n", 2, "2026-01-02"), (3, "n", 1, "31/12")]
    h.merge(delivery(spark, one), 0)
    h.merge(delivery(spark, two), 1)
    want, bad = rows_of(h.read()), sorted(map(str, h.quarantine().collect()))
    h.merge(delivery(spark, two), 1)                                  # committed: nothing happens
    assert rows_of(h.read()) == want and h.store.current_version() == 2
    assert sorted(map(str, h.quarantine().collect())) == bad and len(bad) == 2


def test_a_failed_delivery_starts_over(spark, tmp_dir, monkeypatch):
    """Killed after the data and before the commit: readers see the old version; the second attempt replaces what is left."""
    h = history(spark, tmp_dir)
    h.merge(delivery(spark, [(1, "n", 1, "2026-01-01")]), 0)
    late = [(1, "n", 5, "2025-12-31"), (2, "n", 1, "2026-01-02"), (2, "n", 1, "?")]
    real = store.MANIFEST
    monkeypatch.setattr(store, "MANIFEST", "broken")
    with pytest.raises(Exception):
        h.merge(delivery(spark, late), 1)
    monkeypatch.setattr(store, "MANIFEST", real)
    assert h.read().count() == 1 and h.quarantine().count() == 0
    h.merge(delivery(spark, late), 1)
    assert [(r.k, r.v) for r in h.read().orderBy("k", "effective_start").collect()] == [(1, 5), (1, 1), (2, 1)]
    assert h.quarantine().count() == 1


def test_quarantine_keeps_rule_and_text(spark, tmp_dir):
    h = history(spark, tmp_dir)
    assert h.quarantine() is None
    rows = [(1, "a", "x", "01/02"), (1, "a", "x", "01/02"), (2, "b", 3, None), (3, "c", "y", "2026-01-01"), (None, "d", 1, " ")]
    h.merge(delivery(spark, rows), 0)
    h.merge(delivery(spark, rows[:1], "again.csv"), 1)                 # only undated rows
    got = sorted((str(r.k), r.name, r.v, r._dq_failed_rule, str(r._rescued)) for r in h.quarantine().collect())
    assert got == [("1", "a", None, "snapshot_date_valid", '{"v":"x","d":"01/02"}'), ("2", "b", 3, "snapshot_date_valid", "None"),
                   ("None", "d", 1, "snapshot_date_valid", "None")]
    assert [(r.k, r.v) for r in h.read().collect()] == [(3, None)]
    assert h.store.current_version() == 2


def test_no_dated_row_at_all(spark, tmp_dir):
    h = history(spark, tmp_dir)
    h.merge(delivery(spark, [(1, "a", 1, "?")]), 0)
    assert h.quarantine().count() == 1 and h.versions() is None
    with pytest.raises(FileNotFoundError):
        h.read()
    h.merge(delivery(spark, [(1, "a", 1, "2026-01-01")]), 1)
    assert h.read().count() == 1


def test_rescued_texts(spark):
    df = spark.createDataFrame([("1", "2026-01-01"), ("x", "nope"), ("", None)], "n string, d string")
    got = [tuple(r) for r in clean.try_types(df, {"n": "int", "d": "date"}, rescue=True).collect()]
    assert got == [(1, D(2026, 1, 1), None), (None, None, '{"n":"x","d":"nope"}'), (None, None, None)]
    typed = spark.createDataFrame([(1,)], "n int")
    assert clean.try_types(typed, {"n": "int"}, rescue=True).first() == (1, None)


def test_job_merges_per_delivery_and_publishes_the_history(spark, tmp_dir):
    """Two deliveries and runs: the second merges the new one only; catalog view, quarantine and history agree."""
    from godown.plans import run
    from godown.schemas import SUPPLIERS

    def drop(i, day, bad):
        rows = [(s, f"S{s}", f"addr{s % 3}-{i}", "m", "4.0", day) for s in range(40)] + [(99, "late", "a", "m", "x", bad)]
        df = spark.createDataFrame([tuple(map(str, r)) for r in rows], ", ".join(f"{c} string" for c in SUPPLIERS.columns))
        bronze.write_csv(df, f"{tmp_dir}/in/drop{i}")
    for i, (day, bad) in enumerate([("2026-01-01", "soon"), ("2026-02-01", "soon"), ("2026-03-01", "later")]):
        drop(i, day, bad)
        ingest.stream_feeds(spark, {"suppliers": (SUPPLIERS.raw_schema(), f"{tmp_dir}/in/*")}, f"{tmp_dir}/lake/bronze")
        silver = run.merge_suppliers(spark, f"{tmp_dir}/lake")
        assert silver.current_version() == i + 1
    store.create_schema(spark, "job_silver", f"{tmp_dir}/lake/_schemas/job_silver")
    silver.publish("job_silver.suppliers_scd2")
    assert spark.table("job_silver.suppliers_scd2").count() == silver.read().count() == 120
    bad = spark.read.parquet(f"{tmp_dir}/lake/silver/suppliers_quarantine").collect()
    assert sorted(r._rescued for r in bad) == ['{"rating":"x","source_date":"later"}', '{"rating":"x","source_date":"soon"}']
    # a plain table of that name, as the replaying job publishes it, gives way; and back
    store.overwrite(silver.read(), f"{tmp_dir}/plain")
    store.publish(spark, "job_silver.suppliers_scd2", f"{tmp_dir}/plain", silver.read().schema)
    silver.publish("job_silver.suppliers_scd2")
    assert store.is_view(spark, "job_silver.suppliers_scd2")
