"""Registered SCD2 queries (5.1 - 5.8, 7.15, 8.1, 8.3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from godown.operators import scd2
from godown.oracle import SNAP_DATES, last_per, with_ctes
from godown.plans.pipeline import Layers
from godown.plans.registry import query
from godown.schemas import INGEST_TS, SOURCE_FILE, SUPPLIER_HISTORY_COLUMNS, SUPPLIER_TRACKED
from godown.session import scratch_path
from godown.sources.feeds import SNAPSHOT_DATES
from godown.sources.store import VersionedTable

def _snapshots(spark, sf_dir):
    return Layers(spark, sf_dir).supplier_snapshots.drop(SOURCE_FILE, INGEST_TS)


@query("scd2_replay", with_ctes("SELECT * FROM s_suppliers_scd2"))
def q_scd2_replay(spark, sf_dir):
    return Layers(spark, sf_dir).suppliers_scd2


_LARGE_SQL = with_ctes("""
SELECT customer_id, priority, status, last_order_total, source_date AS effective_start,
       lead(source_date) OVER (PARTITION BY customer_id ORDER BY source_date) AS effective_end,
       lead(source_date) OVER (PARTITION BY customer_id ORDER BY source_date) IS NULL AS is_current
FROM (SELECT *, lag(source_date) OVER w IS NULL
                OR priority IS DISTINCT FROM lag(priority) OVER w
                OR status IS DISTINCT FROM lag(status) OVER w AS _new
      FROM cust_day WHERE source_date IS NOT NULL
      WINDOW w AS (PARTITION BY customer_id ORDER BY source_date))
WHERE _new
""", {"cust_day": last_per("raw_customer_changes", ["customer_id", "source_date"],
                           ["event_seq", "priority", "status", "last_order_total"])})


@query("scd2_replay_history", _LARGE_SQL)
def q_scd2_replay_history(spark, sf_dir):
    """5.1 at size: orders as a change feed of customer priority / status."""
    feed = Layers(spark, sf_dir).raw("customer_changes")
    return scd2.scd2_replay(feed, "customer_id", ("priority", "status"), "source_date", tie=("event_seq",),
                            columns=("customer_id", "priority", "status", "last_order_total"))


@query("scd2_latest", with_ctes(last_per("sup_rows", ["supplier_id"],
                                         ["source_date", "supplier_name", "address", "contact_email", "rating",
                                          "_source_file", "_ingest_timestamp"])))
def q_scd2_latest(spark, sf_dir):
    """5.2 / 8.1: latest snapshot row per supplier."""
    return scd2.latest_per_key(Layers(spark, sf_dir).supplier_snapshots, "supplier_id", "source_date")


_S1 = f"(SELECT * FROM sup_rows WHERE source_date = DATE '{SNAP_DATES[0]}')"


@query("scd2_first_load", with_ctes(f"""
SELECT supplier_id, supplier_name, address, contact_email, rating, source_date AS effective_start,
       CAST(NULL AS DATE) AS effective_end, TRUE AS is_current
FROM ({last_per(_S1, ["supplier_id"], ["source_date", "supplier_name", "address", "contact_email", "rating"])})
"""))
def q_scd2_first_load(spark, sf_dir):
    """5.3: the first snapshot file opens one current version per supplier."""
    snaps = _snapshots(spark, sf_dir)
    first = snaps.where(F.col("source_date") == F.lit(SNAPSHOT_DATES[0]))
    return scd2.first_load(first, "supplier_id", "source_date", columns=SUPPLIER_HISTORY_COLUMNS)


def _merged(spark, sf_dir):
    """First load and one merge per later file; the history is written between batches, as a job would."""
    snaps = _snapshots(spark, sf_dir)
    store = VersionedTable(spark, scratch_path(spark, "merged_suppliers"))
    by_date = [snaps.where(F.col("source_date") == F.lit(d)) for d in SNAPSHOT_DATES]
    store.write(scd2.first_load(by_date[0], "supplier_id", "source_date", columns=SUPPLIER_HISTORY_COLUMNS))
    for i, batch in enumerate(by_date[1:], 1):
        before = snaps.where(F.col("source_date") < F.lit(SNAPSHOT_DATES[i]))
        store.write(scd2.scd2_merge(store.read(), batch, "supplier_id", SUPPLIER_TRACKED, "source_date", snapshots=before))
    return store.read()


# Deliveries that a merge must not get wrong: suppliers without an id, a date
# that doesn't parse, a correction of an earlier day, and a late snapshot.
_D1, _D2 = SNAPSHOT_DATES[1], SNAPSHOT_DATES[2]
_LATE = dt.timedelta(days=10)

IRREGULAR = {
    "irr": f"""
SELECT CASE WHEN supplier_id % 50 = 7 THEN NULL ELSE supplier_id END AS supplier_id, supplier_name, address, contact_email,
       rating, CASE WHEN supplier_id % 30 = 4 AND source_date = DATE '{_D1}' THEN NULL ELSE source_date END AS source_date
FROM sup_rows
UNION ALL
SELECT CASE WHEN supplier_id % 50 = 7 THEN NULL ELSE supplier_id END, supplier_name, 'zz-corrected', contact_email, rating, source_date
FROM sup_rows WHERE source_date = DATE '{_D2}' AND supplier_id % 20 = 3
UNION ALL
SELECT CASE WHEN supplier_id % 50 = 7 THEN NULL ELSE supplier_id END, supplier_name, address, contact_email, 4.9, DATE '{_D1 - _LATE}'
FROM sup_rows WHERE source_date = DATE '{_D1}' AND supplier_id % 20 = 11
""",
    "irr_day": last_per("irr", ["supplier_id", "source_date"], ["supplier_name", "address", "contact_email", "rating"]),
}


def deliveries(spark, sf_dir):
    """Snapshots with the delivery each arrived in, dates as the text that was sent."""
    s = _snapshots(spark, sf_dir)
    k = F.col("supplier_id")
    date = F.col("source_date")
    n = F.when(date == F.lit(SNAPSHOT_DATES[0]), 0).when(date == F.lit(_D1), 1).otherwise(2)
    text = F.when((k % 30 == 4) & (date == F.lit(_D1)), "01/02/xx").otherwise(date.cast("string"))
    regular = s.withColumn("delivery", n).withColumn("source_date", text)
    fixed = (s.where((date == F.lit(_D2)) & (k % 20 == 3)).withColumn("address", F.lit("zz-corrected"))
             .withColumn("delivery", F.lit(3)).withColumn("source_date", date.cast("string")))
    late = (s.where((date == F.lit(_D1)) & (k % 20 == 11)).withColumn("rating", F.lit(4.9))
            .withColumn("delivery", F.lit(3)).withColumn("source_date", F.lit((_D1 - _LATE).isoformat())))
    return regular.unionByName(fixed).unionByName(late).withColumn("supplier_id", F.when(k % 50 != 7, k))


def _deliveries(spark, sf_dir):
    """The same with dates read leniently."""
    return deliveries(spark, sf_dir).withColumn("source_date", F.expr("try_cast(source_date AS date)"))


IRREGULAR_SQL = with_ctes("""
SELECT supplier_id, supplier_name, address, contact_email, rating, source_date AS effective_start,
       lead(source_date) OVER (PARTITION BY supplier_id ORDER BY source_date) AS effective_end,
       lead(source_date) OVER (PARTITION BY supplier_id ORDER BY source_date) IS NULL AS is_current
FROM (SELECT *, lag(source_date) OVER w IS NULL OR address IS DISTINCT FROM lag(address) OVER w
                OR rating IS DISTINCT FROM lag(rating) OVER w AS _new
      FROM irr_day WHERE source_date IS NOT NULL WINDOW w AS (PARTITION BY supplier_id ORDER BY source_date))
WHERE _new
""", IRREGULAR)


@query("scd2_merge_irregular", IRREGULAR_SQL)
def q_scd2_merge_irregular(spark, sf_dir):
    """5.4 - 5.6 over deliveries with NULL keys, bad dates, same-day corrections and late rows; equals the replay."""
    good = scd2.split_snapshots(_deliveries(spark, sf_dir), "supplier_id", "source_date")[0]
    store = VersionedTable(spark, scratch_path(spark, "irregular_suppliers"))
    args = ("supplier_id", SUPPLIER_TRACKED, "source_date")
    store.write(scd2.first_load(good.where("delivery = 0").drop("delivery"), "supplier_id", "source_date", columns=SUPPLIER_HISTORY_COLUMNS))
    for i in (1, 2, 3):
        store.write(scd2.scd2_merge(store.read(), good.where(F.col("delivery") == i).drop("delivery"), *args,
                                    snapshots=good.where(F.col("delivery") < i).drop("delivery")))
    return store.read()


@query("scd2_snapshot_quarantine", with_ctes(
    "SELECT supplier_id, supplier_name, address, contact_email, rating, 'snapshot_date_valid' AS _dq_failed_rule "
    "FROM irr WHERE source_date IS NULL", IRREGULAR))
def q_scd2_snapshot_quarantine(spark, sf_dir):
    """3.3: snapshots whose date doesn't parse, set aside with their rule."""
    bad = scd2.split_snapshots(_deliveries(spark, sf_dir), "supplier_id", "source_date")[1]
    return bad.drop("source_date", "delivery")


@query("scd2_merge", with_ctes("SELECT * FROM s_suppliers_scd2"))
def q_scd2_merge(spark, sf_dir):
    """5.3 - 5.6, 6.4, 6.5: first load, then one MERGE per later snapshot file.

    Equal to the full replay (the differential check of D3).
    """
    return _merged(spark, sf_dir)


@query("scd2_apply_batch", with_ctes("SELECT * FROM s_suppliers_scd2"))
def q_scd2_apply_batch(spark, sf_dir):
    """Two later snapshot files arriving in one batch, applied by touched-key replay."""
    snaps = _snapshots(spark, sf_dir)
    first = snaps.where(F.col("source_date") == F.lit(SNAPSHOT_DATES[0]))
    later = snaps.where(F.col("source_date") > F.lit(SNAPSHOT_DATES[0]))
    hist = scd2.first_load(first, "supplier_id", "source_date", columns=SUPPLIER_HISTORY_COLUMNS)
    return scd2.apply_batch(hist, later, "supplier_id", SUPPLIER_TRACKED, "source_date")


@query("scd2_current_count", with_ctes(
    "SELECT count(*) AS versions, count(*) FILTER (WHERE is_current) AS current_versions FROM s_suppliers_scd2"))
def q_scd2_current_count(spark, sf_dir):
    """7.15: versions and current versions of the supplier history."""
    return scd2.current_count(Layers(spark, sf_dir).suppliers_scd2)


@query("scd2_key_history", with_ctes("""
SELECT * EXCLUDE (_n) FROM (SELECT *, count(*) OVER (PARTITION BY supplier_id) AS _n FROM s_suppliers_scd2)
WHERE _n > 1
"""))
def q_scd2_key_history(spark, sf_dir):
    """5.7: the full history of every supplier that changed at least once."""
    h = Layers(spark, sf_dir).suppliers_scd2
    n = F.count(F.lit(1)).over(Window.partitionBy("supplier_id"))
    return h.withColumn("_n", n).where("_n > 1").drop("_n")


@query("scd2_asof_join", with_ctes("""
SELECT o.order_id, o.supplier_id, o.order_date,
       h.supplier_name AS sup_supplier_name, h.address AS sup_address, h.contact_email AS sup_contact_email,
       h.rating AS sup_rating, h.effective_start AS sup_effective_start
FROM s_orders o
LEFT JOIN (SELECT * FROM s_suppliers_scd2 WHERE effective_end IS NULL OR effective_end > effective_start) h
  ON o.supplier_id = h.supplier_id AND o.order_date >= h.effective_start
 AND (h.effective_end IS NULL OR o.order_date < h.effective_end)
"""))
def q_scd2_asof_join(spark, sf_dir):
    """5.8: every purchase order with the supplier version valid on its order date."""
    L = Layers(spark, sf_dir)
    fact = L.orders.select("order_id", "supplier_id", "order_date")
    return scd2.asof_join(fact, L.suppliers_scd2, "supplier_id", "order_date", prefix="sup_")
