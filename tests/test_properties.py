"""Differential properties on generated inputs (small, few examples: each runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from godown.operators import clean, quality, scd2

D0 = dt.date(2026, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

# snapshot files: each a list of (key, value) with distinct keys; value may be NULL
snapshot = st.dictionaries(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 2)), min_size=1, max_size=5)


def _rows(snaps):
    return [(k, None if v is None else float(v), D0 + dt.timedelta(days=30 * i))
            for i, snap in enumerate(snaps) for k, v in snap.items()]


def _as_set(df):
    return sorted(map(str, df.collect()))


@SETTINGS
@given(st.lists(snapshot, min_size=1, max_size=4))
def test_merge_in_date_order_equals_replay(spark, snaps):
    schema = "k int, v double, d date"
    rows = _rows(snaps)
    replay = scd2.scd2_replay(spark.createDataFrame(rows, schema), "k", ["v"], "d")
    batches = [spark.createDataFrame([r for r in rows if r[2] == D0 + dt.timedelta(days=30 * i)], schema)
               for i in range(len(snaps))]
    hist = scd2.first_load(batches[0], "k", "d")
    for b in batches[1:]:
        hist = scd2.scd2_merge(hist, b, "k", ["v"], "d")
    assert _as_set(hist) == _as_set(replay)
    if len(batches) > 1:
        applied = scd2.apply_batch(scd2.first_load(batches[0], "k", "d"),
                                   spark.createDataFrame([r for b in batches[1:] for r in b.collect()], schema),
                                   "k", ["v"], "d")
        assert _as_set(applied) == _as_set(replay)


@SETTINGS
@given(st.lists(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 2), st.integers(0, 4)), min_size=1, max_size=3),
                min_size=2, max_size=3))
def test_merge_of_any_deliveries_equals_replay(spark, deliveries):
    """Equal dates, late rows and NULL keys in any order; one date per key and delivery."""
    schema = "k int, v double, d date"
    batches = []
    for rows in deliveries:
        once = {k: (k, float(v), D0 + dt.timedelta(days=d)) for k, v, d in rows}
        batches.append(spark.createDataFrame(list(once.values()), schema))
    hist, before = scd2.first_load(batches[0], "k", "d"), batches[0]
    for b in batches[1:]:
        hist = scd2.scd2_merge(hist, b, "k", ["v"], "d", snapshots=before)
        before = before.unionByName(b)
    assert _as_set(hist) == _as_set(scd2.scd2_replay(before, "k", ["v"], "d"))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-2, 2))), min_size=1, max_size=30))
def test_dedupe_and_quality_keep_everything_accounted(spark, pairs):
    df = spark.createDataFrame([(i, k, q) for i, (k, q) in enumerate(pairs)], "i int, k int, q int")
    first = {r.k: r.i for r in clean.dedupe(df, ["k"], ["i"]).collect()}
    want = {}
    for i, (k, _q) in enumerate(pairs):
        want.setdefault(k, i)
    assert first == want
    passed, failed = quality.split(df, {"q_ok": "q >= 0"})
    assert passed.count() + failed.count() == len(pairs)
    assert passed.count() == sum(1 for _k, q in pairs if q is not None and q >= 0)
