"""Slowly changing dimension, type 2 (5.1 - 5.8).

A history row is a *version*: the attribute values of a key from
``effective_start`` (inclusive) to ``effective_end`` (exclusive, NULL =
open); ``is_current`` marks the open version.

Replay (5.1) builds the whole history from all snapshots in two shuffles:

1. one row per (key, snapshot date): the last row of the day by the
   tie-break columns (same-day rule).  The ``row_number() = 1`` filter is
   planned with a partial group limit before the shuffle, so a key with
   very many rows on one day is cut to one row per map task first.
2. ``lag``/``lead`` over each key ordered by date.  After step 1 a key has
   at most one row per distinct date, so the per-key window partition is
   bounded by the calendar, not by the data volume - a key holding a third
   of all rows still only brings its distinct dates to one task.

A new version starts where a tracked column differs from the previous
snapshot of the key, NULL-safe (D5).  Comparing with the previous snapshot
equals comparing with the open version, because unchanged snapshots are
equal to it.  Non-tracked columns come from the first snapshot of the
version (the reference keeps them from the row that opened it).

Merge (5.2 - 5.6) maintains a stored history from one batch at a time:
latest row per key in the batch, a full outer join of current versions
with it (the MERGE match on key + ``is_current``), expire the changed
ones, insert new-or-changed keys.  Applied to snapshots in date order it
equals the replay.  ``apply_batch`` replays only the keys a batch touches
and accepts batches with several snapshot dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from godown.functions.exprs import first_row_flag, quote
from godown.operators import quality
from godown.operators.joins import SALT, dealt, hot_salts, repeated, row_hash
from godown.session import written

START, END, CURRENT = "effective_start", "effective_end", "is_current"
#: Of a maintained history: the newest snapshot date of a row's key.
LAST_SEEN = "_last_seen"
#: Rows with a NULL key match no version; an as-of join deals them over so many groups.
NULL_SALTS = 4096


def _order(df: DataFrame, tie, exclude) -> list[str]:
    """Descending tie-break: explicit tie columns, then every other column."""
    tie = list(tie)
    rest = [c for c in df.columns if c not in tie and c not in exclude]
    return [f"{quote(c)} DESC NULLS LAST" for c in tie + rest]


def last_per_key(df: DataFrame, keys, order_desc_sql) -> DataFrame:
    """First row per key in the given (descending) order; a partial group limit runs before the shuffle."""
    return df.withColumn("_rn", first_row_flag(keys, order_desc_sql)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, key, at: str, tie=()) -> DataFrame:
    """5.2 / 8.1: the latest row per key (by ``at``, then tie-break)."""
    key = [key] if isinstance(key, str) else list(key)
    return last_per_key(df, key, [f"{quote(at)} DESC NULLS LAST"] + _order(df, tie, key + [at]))


def _day_rows(df: DataFrame, key, at, tie) -> DataFrame:
    """One row per (key, date): the last one of the day (same-day rule)."""
    df = df.where(F.col(at).isNotNull())
    return last_per_key(df, key + [at], _order(df, tie, key + [at]))


def scd2_replay(df: DataFrame, key, tracked, at: str, tie=(), columns=None, seen: str | None = None) -> DataFrame:
    """5.1 / 8.3: full version history from all snapshots.

    ``columns``: attribute columns of the history (default: all but
    ``at`` and ``tie``).  Output: key, columns, effective_start,
    effective_end, is_current, and with ``seen`` a column of that name: the
    key's newest snapshot date (unchanged snapshots count, too).
    """
    key = [key] if isinstance(key, str) else list(key)
    tracked = list(tracked)
    if columns is None:
        columns = [c for c in df.columns if c not in key and c != at and c not in tie]
    cols = [c for c in columns if c not in key]
    day = _day_rows(df.select(*key, *cols, at, *[t for t in tie if t not in cols]), key, at, tie)
    w = Window.partitionBy(*key).orderBy(at)
    opens = F.lag(at).over(w).isNull()
    for c in tracked:
        opens = opens | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    if seen is not None:
        day = day.withColumn(seen, F.max(at).over(Window.partitionBy(*key)))
    versions = day.withColumn("_opens", opens).where("_opens").drop("_opens")
    end = F.lead(at).over(w)
    more = [] if seen is None else [seen]
    return (versions.select(*key, *cols, F.col(at).alias(START), end.alias(END), *more)
            .withColumn(CURRENT, F.col(END).isNull()).select(*key, *cols, START, END, CURRENT, *more))


def first_load(batch: DataFrame, key, at: str, tie=(), columns=None) -> DataFrame:
    """5.3: every key of the batch opens a current version at its latest date."""
    key = [key] if isinstance(key, str) else list(key)
    latest = latest_per_key(batch, key, at, tie)
    if columns is None:
        columns = [c for c in batch.columns if c not in key and c != at and c not in tie]
    cols = [c for c in columns if c not in key]
    return latest.select(*key, *cols, F.col(at).alias(START),
                         F.lit(None).cast(batch.schema[at].dataType).alias(END),
                         F.lit(True).alias(CURRENT))


def change_condition(tracked, left: str = "t", right: str = "s"):
    """5.6: OR over NULL-safe differences of the tracked columns."""
    cond = F.lit(False)
    for c in tracked:
        cond = cond | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def snapshot_rules(at: str) -> dict:
    return {"snapshot_date_valid": F.col(at).isNotNull()}


def split_snapshots(rows: DataFrame, key, at: str) -> tuple[DataFrame, DataFrame]:
    """3.3: (usable snapshots, quarantine).

    A snapshot without a readable date can't be placed in a history; it is
    set aside, tagged like every other failed rule.
    """
    return quality.split(rows, snapshot_rules(at))


def _same_key(left: str, right: str, key):
    cond = F.lit(True)
    for k in key:
        cond = cond & F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}"))
    return cond


def keys_only(df: DataFrame, key, prefix: str) -> DataFrame:
    return df.select(*[F.col(k).alias(prefix + k) for k in key]).distinct()


def with_keys(df: DataFrame, keys: DataFrame, key, prefix: str, how: str) -> DataFrame:
    """Rows whose key is (``left_semi``) or isn't (``left_anti``) in ``keys``; NULL is a key like others."""
    return df.join(keys, _same_key("", prefix, key), how)


def scd2_merge(target: DataFrame, batch: DataFrame, key, tracked, at: str, tie=(),
               snapshots: DataFrame | None = None) -> DataFrame:
    """5.4 + 5.5: one MERGE step of a stored history with a batch; equals the replay of everything.

    The batch is reduced to its latest row per key and joined once with the
    target (NULL is a key like others): closed versions are carried along,
    a changed open version is expired at the batch date, new and changed
    keys get a new open version.  A key with a batch row that is not newer
    than its open version (a late row, or a correction of the same day) can't
    be merged: it is replayed from ``snapshots`` (all rows before this
    batch), or from its stored versions where none are given.  Rows without
    a date belong in quarantine (``split_snapshots``) and are left out.
    """
    key = [key] if isinstance(key, str) else list(key)
    own = [c for c in target.columns if c not in (START, END, CURRENT)]
    hist_cols = [c for c in own if c not in key]
    rows = batch.where(F.col(at).isNotNull())
    rest = [c for c in rows.columns if c not in (*key, at, *tie)]
    best = rows.groupBy(*[F.col(k).alias(f"_s_{k}") for k in key]).agg(
        F.min(at).alias("_earliest"), F.max(F.struct(at, *tie, *rest)).alias("_s"))
    opened = F.max(F.when(F.col(CURRENT), F.col(START))).over(Window.partitionBy(*key))
    t = target.withColumn("_open", opened).withColumn("_t", F.lit(True))
    j = t.join(best, _same_key("", "_s_", key), "full_outer")
    known, fresh = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    late = known & fresh & (F.col("_earliest") <= F.col("_open"))
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_s.{c}"))
    changed = known & fresh & F.coalesce(F.col(CURRENT), F.lit(False)) & changed
    no_end = F.lit(None).cast(target.schema[START].dataType)
    old = F.struct(*own, START, F.when(changed, F.col(f"_s.{at}")).otherwise(F.col(END)).alias(END),
                   (F.col(CURRENT) & ~changed).alias(CURRENT))
    new = F.struct(*[(F.col(f"_s_{c}") if c in key else F.col(f"_s.{c}")).alias(c) for c in own],
                   F.col(f"_s.{at}").alias(START), no_end.alias(END), F.lit(True).alias(CURRENT))
    steps = F.when(~known, F.array(new)).when(changed, F.array(old, new)).otherwise(F.array(old))
    merged = j.where(~F.coalesce(late, F.lit(False))).select(F.explode(steps).alias("_v")).select("_v.*")
    late_keys = keys_only(j.where(late), key, "_l_")
    if snapshots is None:
        before = target.select(*own, F.col(START).alias(at), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in tie])
    else:
        before = snapshots.where(F.col(at).isNotNull()).select(*own, at, *tie)
    every = before.withColumn("_seq", F.lit(0)).unionByName(rows.select(*own, at, *tie).withColumn("_seq", F.lit(1)))
    order = ("_seq",) if snapshots is None else tie      # against versions, the batch has the last word of a day
    again = scd2_replay(with_keys(every, late_keys, key, "_l_", "left_semi"), key, tracked, at, order, columns=own)
    return merged.select(*own, START, END, CURRENT).unionByName(again.select(*own, START, END, CURRENT))


def apply_batch(target: DataFrame, batch: DataFrame, key, tracked, at: str, tie=()) -> DataFrame:
    """Incremental maintenance for batches with any number of snapshot dates.

    Versions of the keys the batch touches are turned back into snapshot
    rows and replayed together with the batch; other keys are untouched.
    Exact for in-order batches (every batch date after the key's stored
    versions).
    """
    key = [key] if isinstance(key, str) else list(key)
    hist_cols = [c for c in target.columns if c not in key and c not in (START, END, CURRENT)]
    touched = keys_only(batch, key, "_k_")
    mine = with_keys(target, touched, key, "_k_", "left_semi")
    rest = with_keys(target, touched, key, "_k_", "left_anti")
    as_rows = mine.select(*key, *hist_cols, F.col(START).alias(at),
                          *[F.lit(None).cast(batch.schema[t].dataType).alias(t) for t in tie])
    replayed = scd2_replay(as_rows.unionByName(batch.select(*key, *hist_cols, at, *tie)),
                           key, tracked, at, tie, columns=hist_cols)
    return rest.unionByName(replayed)


def merge_snapshots(history: DataFrame, rows: DataFrame, earlier: DataFrame, key, tracked, at: str, tie=()) -> DataFrame:
    """11.4: a history (with LAST_SEEN) after a delivery of snapshots; equals the replay of everything.

    Only keys of the delivery are replayed: from their versions when all of
    its dates are newer than the newest snapshot the key has had (LAST_SEEN,
    which counts snapshots that changed nothing), else - a late or corrected
    snapshot - from ``earlier``, all snapshots of earlier deliveries.  Other
    keys pass through.  Several dates and several rows of a day are fine.
    """
    key = [key] if isinstance(key, str) else list(key)
    own = [c for c in history.columns if c not in (START, END, CURRENT, LAST_SEEN)]
    cols = [c for c in own if c not in key]
    oldest = rows.groupBy(*[F.col(k).alias(f"_n_{k}") for k in key]).agg(F.min(at).alias("_oldest"), F.lit(True).alias("_touched"))
    old = history.join(oldest, _same_key("", "_n_", key), "left")
    late = F.col("_touched") & (F.col("_oldest") <= F.col(LAST_SEEN))
    blank = [F.lit(None).cast(rows.schema[t].dataType).alias(t) for t in tie]
    as_rows = old.where(F.col("_touched") & ~late).select(*own, F.col(START).alias(at), *blank)
    again = with_keys(earlier.select(*own, at, *tie), keys_only(old.where(late), key, "_l_"), key, "_l_", "left_semi")
    replayed = scd2_replay(as_rows.unionByName(again).unionByName(rows.select(*own, at, *tie)), key, tracked, at, tie,
                           columns=cols, seen=LAST_SEEN)
    return old.where(F.col("_touched").isNull()).select(*history.columns).unionByName(replayed)


def asof_join(fact: DataFrame, history: DataFrame, key, fact_date: str, prefix: str = "") -> DataFrame:
    """5.8: attach the version valid at ``fact_date`` to every fact row.

    A merge, not a join: facts and versions are stacked, and along each key
    by date the last version start goes forward to the facts behind it.  The
    work is linear in facts and versions, however many versions a key has.
    Facts before the first version, in a gap, with a NULL key or without a
    date keep NULLs.  Zero-length versions can't be valid and are dropped.

    Facts of a hot key are dealt over salts, each with a copy of the key's
    versions; the hot keys come from a sketch of the key columns only
    (``joins.hot_salts``).  NULL keys match nothing and are dealt like hot ones.
    """
    key = [key] if isinstance(key, str) else list(key)
    attrs = [c for c in history.columns if c not in key and c not in (END, CURRENT)]
    hot = written(hot_salts(fact, key), "hot_salts")           # at most joins.TOP rows
    null_key = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    h = history.where(F.col(END).isNull() | (F.col(END) > F.col(START))).where(~null_key)
    version = F.struct(*[F.col(c).alias(prefix + c) for c in attrs], F.col(END).alias("_end"))
    versions = repeated(h.select(*key, F.col(START).alias("_at"), version.alias("_version")), key, hot)
    row = F.struct(*[F.col(c) for c in fact.columns])
    facts = dealt(fact.withColumn("_hash", row_hash(fact)), key, hot, F.col("_hash"))
    facts = facts.withColumn(SALT, F.when(null_key, F.pmod("_hash", F.lit(NULL_SALTS)).cast("int")).otherwise(F.col(SALT)))
    facts = facts.select(*key, SALT, F.col(fact_date).alias("_at"), row.alias("_fact"))
    both = facts.unionByName(versions, allowMissingColumns=True)
    along = Window.partitionBy(*key, SALT).orderBy(F.asc_nulls_first("_at"), F.col("_fact").isNotNull())
    last = F.last("_version", True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = both.withColumn("_last", last).where(F.col("_fact").isNotNull())
    valid = F.col("_last._end").isNull() | (F.col("_at") < F.col("_last._end"))
    return out.withColumn("_last", F.when(valid, F.col("_last"))).select("_fact.*", *[F.col(f"_last.{prefix}{c}") for c in attrs])


def current_count(history: DataFrame) -> DataFrame:
    """7.15: number of versions and of current versions."""
    return history.agg(F.count(F.lit(1)).alias("versions"),
                       F.count_if(F.col(CURRENT)).alias("current_versions"))
