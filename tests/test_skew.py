"""A key holding a third of all rows: results stay whole, hot groups are split or pre-reduced."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from godown.operators import clean, scd2
from godown.plans import gold

D = dt.date


def _final_plan(df):
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def skew_conf(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed_facts(spark, n=30000):
    # key 0 holds a third of all rows; the rest spread over 2000 keys
    return spark.range(n).select(
        F.col("id").alias("fact_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.date_add(F.lit(D(2026, 1, 1)), (F.col("id") % 300).cast("int")).alias("at"))


def _dim(spark, n=2001):
    """A dimension that comes out of a window on its key, so it is partitioned by it."""
    rows = spark.range(2 * n).select((F.col("id") % n).alias("k"), (F.col("id") * 2).alias("w"))
    return clean.dedupe(rows, ["k"], ["w"])


def test_split_join_cuts_the_hot_key_at_run_time(spark, skew_conf):
    from godown.operators.joins import split_join
    facts, dim = _skewed_facts(spark), _dim(spark)
    assert "skew=true" not in _final_plan(facts.join(dim, "k", "left"))        # the plain join keeps the hot key in one task
    out = split_join(facts, dim, "k")
    assert "skew=true" in _final_plan(out)
    assert out.columns == ["fact_id", "k", "at", "w"]
    plain = facts.join(dim, "k", "left").select(*out.columns)
    assert out.count() == facts.count() and out.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_equals_plain_join(spark, how):
    from godown.operators.joins import split_join
    facts = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, None, "a"), (4, 9, "a"), (5, 2, "x")], "id int, k int, c string")
    dim = spark.createDataFrame([(1, "a", 10), (1, "b", 20), (2, "y", 30), (None, "a", 40)], "key int, c2 string, v int")
    got = split_join(facts, dim, "k", how, residual=F.col("c") == F.col("c2"), dim_keys="key")
    plain = facts.join(dim, (F.col("k") == F.col("key")) & (F.col("c") == F.col("c2")), how).drop("key")
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    two = split_join(facts, facts.select("k", "c", F.col("id").alias("other")), ["k", "c"], how)
    assert sorted(map(str, two.collect())) == sorted(map(str, facts.join(facts.select("k", "c", F.col("id").alias("other")), ["k", "c"], how)
                                                             .select(*two.columns).collect()))


def test_hot_salts_follow_the_share(spark):
    from godown.operators.joins import hot_salts
    facts = _skewed_facts(spark)
    salts = {r["_key"]: r["_salts"] for r in hot_salts(facts, "k", partitions=60).collect()}
    hot = spark.range(1).select(F.xxhash64(F.lit(0).cast("long"))).first()[0]
    assert salts == {hot: 20}                                                  # a third of 60 partitions' worth


def _asof_brute(facts, versions):
    out = {}
    for i, k, at in facts:
        fit = [v for key, v, a, b in versions if key == k and k is not None and at is not None and a <= at and (b is None or at < b)]
        out[i] = fit[0] if fit else None
    return out


def test_asof_join_equals_brute_force_with_hot_and_null_keys(spark, monkeypatch):
    import random
    monkeypatch.setattr(scd2, "NULL_SALTS", 3)
    r = random.Random(4)
    day = lambda n: D(2026, 1, 1) + dt.timedelta(n)
    versions = []
    for k in [0, 1, 2, 3, None]:
        starts = sorted(r.sample(range(200), 40 if k == 0 else 3))
        for i, a in enumerate(starts):
            end = None if i + 1 == len(starts) and k != 2 else starts[i + 1] if i + 1 < len(starts) else a + 5
            if k == 1 and i == 1:
                end = a                                                        # a version of no length
            if k == 3 and i == 0:
                end = a + 1                                                    # and a gap behind it
            versions.append((k, f"{k}-{i}", day(a), None if end is None else day(end)))
    facts = [(i, r.choice([0, 0, 0, 1, 2, 3, 7, None]), None if r.random() < 0.05 else day(r.randrange(-5, 210))) for i in range(900)]
    h = spark.createDataFrame([(k, v, a, b, b is None) for k, v, a, b in versions],
                              "k int, name string, effective_start date, effective_end date, is_current boolean")
    f = spark.createDataFrame(facts, "id int, k int, at date")
    out = scd2.asof_join(f, h, "k", "at", prefix="h_")
    assert out.columns == ["id", "k", "at", "h_name", "h_effective_start"]
    got = out.collect()
    assert len(got) == len(facts)
    assert {x["id"]: x["h_name"] for x in got} == _asof_brute(facts, versions)


def test_asof_join_is_linear_in_versions(spark):
    """A key with 10,000 versions and a third of the facts: no join, every window row is a fact or a version (once per salt)."""
    facts = _skewed_facts(spark)
    start = spark.range(10_000).select(F.lit(0).cast("long").alias("k"), F.col("id").alias("v"),
                                       F.date_add(F.lit(D(2000, 1, 1)), F.col("id").cast("int")).alias("effective_start"))
    hist = start.withColumn("effective_end", F.date_add("effective_start", 1)).withColumn("is_current", F.lit(False))
    out = scd2.asof_join(facts, hist, "k", "at", prefix="h_")
    plan = _final_plan(out)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") <= 4    # hot keys only, on both sides, initial and final plan
    assert "skew" not in plan
    hit = out.where("k = 0").agg(F.count("h_v"), F.count(F.lit(1)), F.count_if(F.date_add(F.lit(D(2000, 1, 1)), F.col("h_v").cast("int")) == F.col("at")))
    assert tuple(hit.first()) == (10_000, 10_000, 10_000)


def test_dedupe_of_a_hot_key_is_exact(spark):
    rows = spark.range(60000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("v"))
    out = clean.dedupe(rows, ["k"], ["v"])
    assert out.count() == 40001
    assert out.where("k = -1").first().v == 0


def test_hot_product_aggregates_exactly(spark):
    sales = spark.range(30000).select(
        F.col("id").alias("sale_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), (F.col("id") % 500).cast("string")))
         .alias("product_id"),
        F.lit(2).alias("quantity_sold"), F.lit("1.50").cast("decimal(18,2)").alias("revenue"))
    products = sales.select("product_id").distinct().select("product_id", F.col("product_id").alias("product_name"),
                                                            F.lit("c").alias("category"))
    got = {r.product_id: r for r in gold.product_movement(sales, products).collect()}
    assert got["HOT"].total_units_sold == 20000 and got["HOT"].num_sales_txns == 10000
    assert got["HOT"].movement_category == "Fast-moving"


@pytest.mark.parametrize("shape", ["hot_value", "distinct", "wide_range"])
def test_exact_quantiles_equal_percentile(spark, shape):
    from godown.operators.quantiles import exact_quantiles
    if shape == "hot_value":   # one value holds 70 % of the rows
        v = F.when(F.col("id") % 10 < 7, F.lit(500.0)).otherwise((F.col("id") * 7919 % 1000).cast("double"))
    elif shape == "distinct":  # all values distinct
        v = (F.col("id") * 7919 % 100003) / 3.0
    else:                      # equal widths would need hundreds of rounds
        v = F.pow(F.lit(10.0), (F.col("id") * 7919 % 600) - 300) * F.when(F.col("id") % 2 == 0, -1).otherwise(1)
    probs = [0.5, 0.33, 0.66, 0.0, 1.0]
    df = spark.range(20000).select(v.alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k")).unionByName(
        spark.createDataFrame([(None, 9), (None, 1), (7.5, 10)], "v double, k long"))
    want = df.agg(F.percentile("v", F.array(*map(F.lit, probs)))).first()[0]
    by_key = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, probs))).alias("q")).collect() if r.q}
    for small in (200_000, 50):                    # with and without rounds of narrowing
        assert exact_quantiles(df, "v", probs, small=small, slices=8).first().q == pytest.approx(want, rel=1e-12)
        got = {r.g: r.q for r in exact_quantiles(df, "v", probs, "k", small=small, slices=8).collect()}
        assert set(got) == set(by_key)
        for k in got:
            assert got[k] == pytest.approx(by_key[k], rel=1e-12)


def test_quantiles_of_nothing(spark):
    from godown.operators.quantiles import exact_quantiles, quantile_values
    none = spark.createDataFrame([(None, 1)], "v double, k int")
    assert exact_quantiles(none, "v", [0.5]).count() == 0 and exact_quantiles(none, "v", [0.5], "k").count() == 0
    assert spark.range(1).select(*quantile_values(none, "v", [0.5, 0.1])).first() == (None, None)


def test_quantiles_evaluate_their_input_once(spark, monkeypatch):
    """Any number of cuts and rounds: one write reads the input, the rest reads what was written."""
    from godown.operators import quantiles
    plans = []
    real = quantiles.written

    def spy(df, *name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *name)
    monkeypatch.setattr(quantiles, "written", spy)
    df = spark.range(5000).select((F.col("id") * 31 % 4999).cast("double").alias("v"))
    out = quantiles.exact_quantiles(df, "v", [0.1, 0.5, 0.9], small=100, slices=8)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 3 and [p.count("Range (0, 5000") for p in plans] == [1] + [0] * (len(plans) - 1)


def test_no_task_orders_more_than_the_bracket(spark):
    """Distinct values of every bracket that is ordered stay within the bound, 70 % at one value or all distinct."""
    from godown.operators import quantiles
    df = spark.range(30_000).select((F.col("id") * 7919 % 100003).cast("double").alias("v"))
    values, rows = quantiles.value_counts(df, "v")
    assert rows == 30_000
    b = values.groupBy("k").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("rows")).select(
        "k", F.lit(0).alias("i"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
        F.lit(0).cast("long").alias("below"), (F.col("n") * 0.4).alias("pos"), "rows")
    sizes = []
    for _ in range(3):
        b = quantiles.written(quantiles._narrowed(values, b, 16), "test_brackets")
        sizes.append(b.first()["rows"])
    assert sizes[0] < 30_000 / 16 * 2.5 and sizes[1] < sizes[0] / 16 * 2.5 + 2 and sizes[2] <= sizes[1]
