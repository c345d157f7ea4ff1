"""One test per edge decision, on inline fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import write_text
from godown.operators import clean, quality, scd2
from godown.plans import gold
from godown.sources import bronze

D = dt.date


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("a", "x", "x"), ("b", "7", "2026-06-01")], "id string, qty string, d string")
    rows = {r.id: r for r in clean.try_types(df, {"qty": "int", "d": "date"}).collect()}
    assert rows["a"].qty is None and rows["a"].d is None
    assert rows["b"].qty == 7 and rows["b"].d == D(2026, 6, 1)


def test_missing_quantity_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", "oops"), ("c", "3")], "id string, q string")
    got = {r.id: r.q for r in clean.try_types(df, {"q": "int"}, zero_fill=("q",)).collect()}
    assert got == {"a": 0, "b": 0, "c": 3}                                  # D10


def test_null_rule_result_is_quarantined(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, -1)], "id int, q int")
    passed, failed = quality.split(df, {"q_non_negative": "q >= 0"})
    assert [r.id for r in passed.collect()] == [1]
    assert sorted(r.id for r in failed.collect()) == [2, 3]                 # D9: nothing lost
    assert {r._dq_failed_rule for r in failed.collect()} == {"q_non_negative"}
    counts = quality.rule_counts(df, {"q_non_negative": "q >= 0"}, "t").first()
    assert (counts.passed, counts.quarantined) == (1, 2)


def test_several_failed_rules_are_listed(spark):
    df = spark.createDataFrame([(1, -1, -5)], "id int, a int, b int")
    _, failed = quality.split(df, {"a_ok": "a >= 0", "b_ok": "b >= 0"})
    assert failed.first()._dq_failed_rule == "a_ok,b_ok"


def test_quarantine_does_not_pile_up(spark):
    df = spark.createDataFrame([(1, -1)], "id int, q int")
    _, failed = quality.split(df, {"q_ok": "q >= 0"})
    again = quality.new_quarantine_rows(failed, failed, ["id"])
    assert again.count() == 0                                               # D9 re-run


def test_filter_before_dedupe_keeps_good_row(spark):
    # D12: the first row of P1 lacks its name, a later row is complete
    df = spark.createDataFrame(
        [("P1", None, 1.0, "a.csv", dt.datetime(2026, 1, 1)), ("P1", "Good", 2.0, "b.csv", dt.datetime(2026, 1, 2))],
        "product_id string, product_name string, unit_price double, _source_file string, "
        "_ingest_timestamp timestamp")
    out = clean.drop_incomplete(df, ["product_id", "product_name"])
    out = clean.dedupe(out, ["product_id"]).collect()
    assert [(r.product_id, r.product_name) for r in out] == [("P1", "Good")]


def test_first_ingested_duplicate_wins(spark):
    # D13: explicit order - earliest ingest, then file name, then the other columns
    df = spark.createDataFrame(
        [("k", "late", "b.csv", dt.datetime(2026, 1, 2)), ("k", "early", "a.csv", dt.datetime(2026, 1, 1)),
         ("k", "same-ts", "c.csv", dt.datetime(2026, 1, 1))],
        "id string, v string, _source_file string, _ingest_timestamp timestamp")
    assert clean.dedupe(df, ["id"]).first().v == "early"


def test_category_median(spark):
    df = spark.createDataFrame([("a", "X", 1.0), ("b", "X", 3.0), ("c", "X", None), ("d", "Y", 10.0),
                                ("e", "Y", None)], "id string, category string, p double")
    got = {r.id: r.p for r in clean.impute_median(df, "p", by="category").collect()}
    assert got["c"] == 2.0 and got["e"] == 10.0                             # 3.8
    glob = {r.id: r.p for r in clean.impute_median(df, "p").collect()}
    assert glob["c"] == 3.0                                                 # 3.7: global median of 1, 3, 10


def _hist(spark, rows, schema="k string, v double, d date"):
    df = spark.createDataFrame(rows, schema)
    return sorted(((r.k, r.v, r.effective_start, r.effective_end, r.is_current)
                   for r in scd2.scd2_replay(df, "k", ["v"], "d").collect()), key=lambda t: (t[0], t[2]))


def test_scd_null_is_null_safe(spark):
    rows = [("a", None, D(2026, 1, 1)), ("a", None, D(2026, 2, 1)), ("a", 1.0, D(2026, 3, 1))]
    assert _hist(spark, rows) == [("a", None, D(2026, 1, 1), D(2026, 3, 1), False),
                                  ("a", 1.0, D(2026, 3, 1), None, True)]    # D5


def test_scd_between_versions_kept(spark):
    rows = [("a", 1.0, D(2026, 1, 1)), ("a", 2.0, D(2026, 2, 1)), ("a", 3.0, D(2026, 3, 1))]
    assert [h[1] for h in _hist(spark, rows)] == [1.0, 2.0, 3.0]            # D3


def test_scd_late_snapshot_spliced_in(spark):
    # A@1, A@5 (unchanged), then B@3 arrives late: replay gives A, B, A
    rows = [("a", 1.0, D(2026, 1, 1)), ("a", 1.0, D(2026, 5, 1)), ("a", 2.0, D(2026, 3, 1))]
    assert _hist(spark, rows) == [("a", 1.0, D(2026, 1, 1), D(2026, 3, 1), False),
                                  ("a", 2.0, D(2026, 3, 1), D(2026, 5, 1), False),
                                  ("a", 1.0, D(2026, 5, 1), None, True)]


def test_scd_same_day_last_by_tie_wins(spark):
    df = spark.createDataFrame([("a", 1.0, D(2026, 1, 1), 1), ("a", 2.0, D(2026, 1, 1), 2)],
                               "k string, v double, d date, seq int")
    h = scd2.scd2_replay(df, "k", ["v"], "d", tie=("seq",)).collect()
    assert [(r.v, r.is_current) for r in h] == [(2.0, True)]


def test_reingested_file_makes_no_version(spark):
    df = spark.createDataFrame(
        [("a", 1.0, D(2026, 1, 1), "f1.csv", dt.datetime(2026, 1, 1)),
         ("a", 1.0, D(2026, 1, 1), "f1.csv", dt.datetime(2026, 1, 5))],
        "k string, v double, d date, _source_file string, _ingest_timestamp timestamp")
    rows = clean.dedupe_rows(df).drop("_source_file", "_ingest_timestamp")
    assert rows.count() == 1                                                # D4
    assert scd2.scd2_replay(rows, "k", ["v"], "d").count() == 1


def test_merge_equals_replay_for_late_rows_null_keys_and_same_day_corrections(spark):
    s = "k string, v double, d date"
    b1 = spark.createDataFrame([("a", 1.0, D(2026, 1, 1)), ("b", 1.0, D(2026, 1, 1)), (None, 7.0, D(2026, 1, 1))], s)
    b2 = spark.createDataFrame([("a", 2.0, D(2026, 2, 1)), ("c", 5.0, D(2026, 2, 1)), (None, 8.0, D(2026, 2, 1))], s)
    b3 = spark.createDataFrame([("a", 9.0, D(2026, 1, 15)), ("c", 6.0, D(2026, 2, 1)), ("b", 1.0, D(2026, 3, 1))], s)
    h = scd2.first_load(b1, "k", "d")
    h = scd2.scd2_merge(h, b2, "k", ["v"], "d", snapshots=b1)
    assert sorted(map(str, h.collect())) == sorted(map(str, scd2.scd2_replay(b1.unionByName(b2), "k", ["v"], "d").collect()))
    every = b1.unionByName(b2).unionByName(b3)
    want = sorted(map(str, scd2.scd2_replay(every, "k", ["v"], "d").collect()))
    assert sorted(map(str, scd2.scd2_merge(h, b3, "k", ["v"], "d", snapshots=b1.unionByName(b2)).collect())) == want
    assert sorted(map(str, scd2.scd2_merge(h, b3, "k", ["v"], "d").collect())) == want


def test_snapshots_without_a_date_go_to_quarantine(spark):
    rows = spark.createDataFrame([("a", D(2026, 1, 1)), ("b", None)], "k string, d date")
    good, bad = scd2.split_snapshots(rows, "k", "d")
    assert [r.k for r in good.collect()] == ["a"]
    assert [(r.k, r._dq_failed_rule) for r in bad.collect()] == [("b", "snapshot_date_valid")]


def test_apply_batch_with_several_dates(spark):
    s = "k string, v double, d date"
    b1 = spark.createDataFrame([("a", 1.0, D(2026, 1, 1))], s)
    b2 = spark.createDataFrame([("a", 2.0, D(2026, 2, 1)), ("a", 2.0, D(2026, 3, 1)),
                                ("a", 3.0, D(2026, 4, 1))], s)
    h = scd2.apply_batch(scd2.first_load(b1, "k", "d"), b2, "k", ["v"], "d")
    assert sorted(r.v for r in h.collect()) == [1.0, 2.0, 3.0]


def test_asof_join(spark):
    hist = scd2.scd2_replay(spark.createDataFrame(
        [("a", 1.0, D(2026, 1, 1)), ("a", 2.0, D(2026, 3, 1))], "k string, v double, d date"), "k", ["v"], "d")
    fact = spark.createDataFrame([(1, "a", D(2025, 12, 1)), (2, "a", D(2026, 2, 1)), (3, "a", D(2026, 3, 1)),
                                  (4, "z", D(2026, 3, 1))], "id int, k string, at date")
    got = {r.id: r.h_v for r in scd2.asof_join(fact, hist, "k", "at", prefix="h_").collect()}
    assert got == {1: None, 2: 1.0, 3: 2.0, 4: None}                        # 5.8, left join keeps all


def test_orphan_orders_kept_and_unknown_delay_not_late(spark):
    orders = spark.createDataFrame(
        [(1, "S1", 0, 5), (2, "S1", 2, 5), (3, "S1", None, 5), (4, "SX", 1, 5)],
        "order_id int, supplier_id string, delay_days int, quantity_ordered int")
    hist = spark.createDataFrame([("S1", "One", 4.0, True)],
                                 "supplier_id string, supplier_name string, rating double, is_current boolean")
    got = {r.supplier_id: r for r in gold.supplier_performance(orders, hist, count_unknown=True).collect()}
    assert got["S1"].on_time_pct == 50.0 and got["S1"].orders_unknown_delay == 1   # D7
    assert got["S1"].total_orders == 3
    assert got["SX"].supplier_name is None and got["SX"].total_orders == 1        # D6


def test_zero_month_and_null_date(spark):
    df = spark.createDataFrame(
        [(1, D(2026, 1, 5), 1, "0.00"), (2, D(2026, 2, 5), 1, "10.00"), (3, None, 1, "5.00"),
         (4, D(2026, 4, 5), 1, "20.00")],
        "sale_id int, sale_date date, quantity_sold int, revenue string") \
        .withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
    got = {r.month: r.revenue_growth_pct for r in gold.sales_trends(df).collect()}
    assert got["2026-02"] is None                                           # D14: after a zero month
    assert got[None] is None                                                # D15: kept, not chained
    assert got["2026-04"] == 100.0                                          # gaps are not filled


def test_tie_on_cut_goes_fast(spark):
    sales = spark.createDataFrame([(i, f"P{i}", 10, "1.00") for i in range(3)],
                                  "sale_id int, product_id string, quantity_sold int, revenue string")
    products = spark.createDataFrame([(f"P{i}", f"n{i}", "c") for i in range(3)],
                                     "product_id string, product_name string, category string")
    got = {r.movement_category for r in gold.product_movement(sales, products).collect()}
    assert got == {"Fast-moving"}                                           # >= fast is tested first


def test_new_column_is_additive(spark, tmp_dir):
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{tmp_dir}/p1")
    spark.createDataFrame([(2, "b", "new")], "id int, v string, extra string").write.parquet(f"{tmp_dir}/p2")
    got = {r.id: r.extra for r in bronze.read_evolving(spark, [f"{tmp_dir}/p1", f"{tmp_dir}/p2"]).collect()}
    assert got == {1: None, 2: "new"}
    a = spark.createDataFrame([(1,)], "id int")
    b = spark.createDataFrame([(2, "x")], "id int, extra string")
    assert bronze.union_evolving(a, b).count() == 2


def test_schema_inferred_once_and_reloaded(spark, tmp_dir):
    write_text(f"{tmp_dir}/in/a.csv", "id,qty,d\n1,5,2026-01-01\n")
    st = bronze.infer_schema(spark, f"{tmp_dir}/in/a.csv", f"{tmp_dir}/schema")
    assert [f.dataType.simpleString() for f in st.fields] == ["int", "int", "date"]
    write_text(f"{tmp_dir}/in/b.csv", "id,qty,d\nx,y,z\n")
    again = bronze.infer_schema(spark, f"{tmp_dir}/in/b.csv", f"{tmp_dir}/schema")
    assert again == st                                                      # stored copy wins


@pytest.mark.parametrize("value, expected", [(0.125, 0.13), (2.675, 2.68), (-0.125, -0.13)])
def test_round_is_half_up(spark, value, expected):
    assert spark.range(1).select(F.round(F.lit(value), 2).alias("r")).first().r == expected   # D8


def test_drop_null_groups_option(spark):
    orders = spark.createDataFrame([(1, "S1", 0, 5), (2, "SX", 1, 5)],
                                   "order_id int, supplier_id string, delay_days int, quantity_ordered int")
    hist = spark.createDataFrame([("S1", "One", 4.0, True)],
                                 "supplier_id string, supplier_name string, rating double, is_current boolean")
    assert gold.supplier_performance(orders, hist).count() == 2
    assert [r.supplier_id for r in gold.supplier_performance(orders, hist, drop_null_groups=True).collect()] == ["S1"]


def test_step_counts_report_zero_filled(spark):
    from godown.schemas import SALES
    raw = spark.createDataFrame(
        [(1, 1, 1, "2026-01-01", "2", "1.0", "2.00"), (2, 1, 1, "2026-01-01", "x", "1.0", "2.00"),
         (2, 1, 1, "2026-01-01", "3", "1.0", "2.00"), (3, None, 1, "2026-01-01", None, "1.0", "2.00")],
        "sale_id long, product_id long, warehouse_id int, sale_date string, quantity_sold string, "
        "unit_price string, revenue string")
    r = clean.step_counts(raw, SALES).first()
    assert (r.rows_in, r.zero_filled, r.after_required, r.after_filter, r.rows_out) == (4, 2, 3, 2, 2)


def test_stream_infers_and_stores_schema(spark, tmp_dir):
    from godown.streaming import ingest
    write_text(f"{tmp_dir}/in/a/part.csv", "id,qty\n1,5\n2,6\n")
    n = ingest.stream_feed(spark, None, f"{tmp_dir}/in/*", f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert n == 2
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert dict(out.dtypes)["qty"] == "int"
    assert spark.read.text(f"{tmp_dir}/ck_schema").count() == 1


def test_typed_read_parses_dates(spark, tmp_dir):
    from pyspark.sql import types as T
    write_text(f"{tmp_dir}/in/x.csv", "id,d\n1,01/06/2026\n2,bad\n")
    st = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("d", T.DateType())])
    got = {r.id: r.d for r in bronze.read_feed(spark, None, f"{tmp_dir}/in/x.csv", schema=st,
                                               date_format="dd/MM/yyyy").collect()}
    assert got == {1: D(2026, 6, 1), 2: None}


def test_one_stream_per_feed(spark, tmp_dir):
    from godown.schemas import WAREHOUSE
    from godown.streaming import ingest
    write_text(f"{tmp_dir}/raw/warehouse/a.csv", "warehouse_id,warehouse_name,location,capacity\nW1,n,l,5\n")
    write_text(f"{tmp_dir}/raw/other/a.csv", "warehouse_id,warehouse_name,location,capacity\nW2,n,l,5\nW3,n,l,6\n")
    got = ingest.stream_feeds(spark, {"warehouse": (WAREHOUSE.raw_schema(), f"{tmp_dir}/raw/warehouse"),
                                      "other": (WAREHOUSE.raw_schema(), f"{tmp_dir}/raw/other")}, f"{tmp_dir}/bronze")
    assert got == {"warehouse": 1, "other": 2}
    assert spark.read.parquet(f"{tmp_dir}/bronze/other").count() == 2


def test_presentation_order(spark):
    snap = spark.createDataFrame([(1, 5, 10), (2, 1, 10), (3, 7, 10), (4, 1, 10)],
                                 "inventory_id int, quantity_on_hand int, reorder_threshold int")
    rows = gold.ordered(gold.low_stock_alerts(snap), "low_stock_alerts").collect()
    assert [(r.inventory_id, r.shortfall) for r in rows] == [(2, 9), (4, 9), (1, 5), (3, 3)]   # 9.1 + key tie-break


def test_publish_switches_and_evolves(spark, tmp_dir):
    from godown.sources import store
    t = store.VersionedTable(spark, f"{tmp_dir}/t")
    store.create_schema(spark, "edge_layer", f"{tmp_dir}/schema")
    t.write(spark.range(3))
    store.publish(spark, "edge_layer.t", t.path(1), t.read().schema)
    t.write(spark.range(5))
    store.publish(spark, "edge_layer.t", t.path(2), t.read().schema)
    assert spark.table("edge_layer.t").count() == 5
    t.write(spark.range(2).withColumn("extra", F.lit("x")))
    store.publish(spark, "edge_layer.t", t.path(3), t.read().schema)
    assert spark.table("edge_layer.t").columns == ["id", "extra"]


def test_csv_columns_are_matched_by_name(spark, tmp_dir):
    from godown.schemas import WAREHOUSE
    write_text(f"{tmp_dir}/in/a.csv", "warehouse_id,warehouse_name,location,capacity\nW1,one,x,5\n")
    write_text(f"{tmp_dir}/in/b.csv", "warehouse_name,warehouse_id,region,capacity\n\"two, b\",W2,North,6\n")
    got = {r.warehouse_id: r for r in bronze.read_feed(spark, WAREHOUSE, f"{tmp_dir}/in").collect()}
    assert (got["W2"].warehouse_name, got["W2"].capacity, got["W2"].location, got["W2"].region) == ("two, b", "6", None, "North")
    assert (got["W1"].location, got["W1"].region, got["W1"]._source_file) == ("x", None, "a.csv")


def test_a_damaged_commit_log_raises_and_keeps_the_table(spark, tmp_dir):
    import glob
    from godown.sources import store
    t = store.VersionedTable(spark, f"{tmp_dir}/t")
    t.write(spark.range(5))
    for f in glob.glob(f"{tmp_dir}/t/_commits/part-*"):
        with open(f, "w") as fh:
            fh.write("garbled")
    for f in glob.glob(f"{tmp_dir}/t/_commits/.*.crc"):
        with open(f, "w") as fh:
            fh.write("garbled")
    with pytest.raises(Exception):
        t.exists()
    with pytest.raises(Exception):
        t.write(spark.range(1))
    assert spark.read.parquet(t.path(1)).count() == 5


def test_versions_are_never_replaced(spark, tmp_dir):
    from godown.sources import store
    t = store.VersionedTable(spark, f"{tmp_dir}/t")
    t.write(spark.range(5), 1)
    with pytest.raises(FileExistsError):
        t.write(spark.range(1), 1)
    spark.range(3).write.parquet(t.path(2))                  # left by an attempt that didn't commit
    with pytest.raises(Exception):
        t.write(spark.range(1))
    t.write(spark.range(2), 2)
    assert t.read().count() == 2


def test_old_files_land_and_many_batches_are_counted(spark, tmp_dir):
    import os
    import time
    from godown.schemas import WAREHOUSE
    from godown.streaming import ingest
    for i in range(6):
        write_text(f"{tmp_dir}/in/f{i}.csv", f"warehouse_id,warehouse_name,location,capacity\nW{i},n,l,5\n")
    os.utime(f"{tmp_dir}/in/f3.csv", (time.time() - 30 * 86400,) * 2)
    n = ingest.stream_feed(spark, WAREHOUSE.raw_schema(), f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck", max_files_per_trigger=1)
    assert n == 6 and ingest.read_landed(spark, f"{tmp_dir}/out").count() == 6


def test_quarantine_knows_null_keys_and_empty_tables(spark, tmp_dir):
    rows = spark.createDataFrame([(None, "r1"), (1, "r1")], "id int, _dq_failed_rule string")
    assert quality.new_quarantine_rows(rows, rows, ["id"]).count() == 0
    from godown.plans import run
    from godown.plans.pipeline import Layers

    class Empty(Layers):
        products = spark.createDataFrame([], "product_id string, product_name string, category string, unit_price double, supplier_id string")
    for _ in range(2):
        t = run._write_one_silver(spark, Empty(spark, ""), tmp_dir, "products", True)
        assert t.read().count() == 0 and "_dq_failed_rule" not in t.read().columns


def test_matrix_rows_add_up(spark):
    from godown.plans import dashboard
    s = spark.createDataFrame([(1, "w", "A", 10.0), (1, "w", None, 5.0), (1, "w", "Z", 7.0)],
                              "warehouse_id int, warehouse_name string, category string, total_revenue double")
    row = dashboard.sales_matrix(s, ["A"]).first()
    assert (row.revenue_a, row.revenue_other) == (10.0, 12.0)
