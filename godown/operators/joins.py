"""Joins and windows over a fact whose key may be hot.

``split_join`` leaves hot keys to Spark at run time.  AQE splits a skewed
partition of a sort-merge join only when both inputs are shuffled for that
join.  A dimension that comes out of a window or an aggregate on its key (a
type-2 history, deduplicated products) is partitioned already and would be
used as it is; then a key that holds a third of the fact lands in one task.
A second join column makes both sides be dealt anew: a constant that is
computed from the key, so that the optimizer can't drop it.  AQE then reads
the measured sizes: a small dimension is broadcast, a skewed partition is cut
by the fact's map outputs and the dimension's part repeated for each cut.
The fact is evaluated once, no sample or salt is needed, and nothing about
the result depends on it.

A window can't be split that way.  ``hot_salts`` finds its heavy keys with a
mergeable sketch over the key columns only (``approx_top_k``: at most ``TOP``
keys) and says over how many salts the rows of each should go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEAL = "_deal"
SALT = "_salt"
#: Keys that can be hot, and items that the sketch tracks for them.
TOP, TRACKED = 1_000, 10_000


def _as_list(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _deal(keys) -> Column:
    """0 for every key, but only known when the key is."""
    return F.hash(*keys).bitwiseAND(F.lit(0))


def split_join(fact: DataFrame, dim: DataFrame, keys, how: str = "left", residual: Column | None = None,
               dim_keys=None) -> DataFrame:
    """``fact JOIN dim ON fact.keys = dim.dim_keys [AND residual]``, hot keys of the fact split at run time.

    ``how`` is ``inner`` or ``left``.  ``dim_keys`` names the dimension's key
    columns when they differ from the fact's; they are dropped.  A NULL key
    matches nothing.
    """
    keys = _as_list(keys)
    dim_keys = keys if dim_keys is None else _as_list(dim_keys)
    if how not in ("inner", "left"):
        raise ValueError("split_join supports inner and left joins")
    mine = [f"_dim_{k}" for k in dim_keys]
    d = dim.select(*[F.col(c).alias(f"_dim_{c}") if c in dim_keys else F.col(c) for c in dim.columns])
    d = d.withColumn(f"_dim{DEAL}", _deal(mine))
    cond = F.col(DEAL) == F.col(f"_dim{DEAL}")
    for k, m in zip(keys, mine):
        cond = cond & (F.col(k) == F.col(m))
    if residual is not None:
        cond = cond & residual
    return fact.withColumn(DEAL, _deal(keys)).join(d, cond, how).drop(DEAL, f"_dim{DEAL}", *mine)


def row_hash(df: DataFrame) -> Column:
    """A hash of each row's hashable columns (map columns cannot be hashed)."""
    return F.xxhash64(*[F.col(c) for c, t in df.dtypes if not t.startswith("map")])


def hot_salts(df: DataFrame, keys, partitions: int | None = None) -> DataFrame:
    """(_key, _salts): hashes of keys with more than one partition's share of the rows, and over how many salts to deal them.

    One pass over the key columns with partial aggregation; at most ``TOP``
    rows, so it may be broadcast.  ``partitions`` defaults to the number of
    shuffle partitions.  A recomputed task finds the same keys.
    """
    p = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = (df.select(F.xxhash64(*_as_list(keys)).alias("_key"))
           .agg(F.expr(f"approx_top_k(_key, {TOP}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")))
    share = F.col("t.count") / F.col("n") * p
    return (top.select("n", F.explode("top").alias("t")).where(share > 1)
            .select(F.col("t.item").alias("_key"), F.ceil(share).cast("int").alias("_salts")))


def dealt(df: DataFrame, keys, hot: DataFrame, by: Column) -> DataFrame:
    """Adds SALT: 0, or for a hot key one of its salts, by the hash ``by``."""
    out = df.withColumn("_key", F.xxhash64(*_as_list(keys))).join(F.broadcast(hot), "_key", "left")
    return out.withColumn(SALT, F.when(F.col("_salts") > 0, F.pmod(by, F.col("_salts"))).otherwise(0).cast("int")).drop("_key", "_salts")


def repeated(df: DataFrame, keys, hot: DataFrame) -> DataFrame:
    """Adds SALT: every row once, rows of a hot key once per salt."""
    out = df.withColumn("_key", F.xxhash64(*_as_list(keys))).join(F.broadcast(hot), "_key", "left")
    return out.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_key", "_salts")
