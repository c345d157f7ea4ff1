"""Quantiles of a column, global or per group (3.7, 3.8, 7.7 - 7.9).

``exact`` is the interpolated quantile at position ``p * (n - 1)`` between
two order statistics.  The input is evaluated once for any number of
quantiles: rows become (group, value, count), which cuts ties and hot groups
to one row per task and value, and that table is written.  All further steps
read it.  Each wanted rank starts with the whole value range as its bracket.
While a bracket holds more than ``SMALL`` distinct values, a round cuts it
into ``SLICES`` parts of about as many distinct values each (a small
sketch says where; it only routes), adds up the counts per part, and keeps
the parts that hold the rank.  So no task sorts more than ``SMALL`` values,
and twelve digits of distinct values need some three rounds.

``approx`` is ``percentile_approx``: an existing value within rank error
``1 / accuracy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from godown.operators.joins import split_join
from godown.session import written

#: Distinct values that one task may order, and parts that a round makes of a bracket.
SMALL = 200_000
SLICES = 64


def value_counts(df: DataFrame, c: str, by: str | None = None) -> tuple[DataFrame, int]:
    """(g, k, x, w): how often each value occurs per group, written; ``k`` tells groups apart, NULL too.  With its number of rows."""
    g = F.lit(None).cast("string") if by is None else F.col(by)
    x = df.select(g.alias("g"), F.col(c).cast("double").alias("x")).where(F.col("x").isNotNull())
    counts = x.groupBy("g", "x").agg(F.count(F.lit(1)).alias("w")).select("g", F.to_json(F.struct("g")).alias("k"), "x", "w")
    rows = Observation()
    out = written(counts.observe(rows, F.count(F.lit(1)).alias("rows")), "value_counts")
    return out, rows.get["rows"]


def _inside(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """The values of each bracket."""
    at = (F.col("x") >= F.coalesce("lo", "x")) & (F.col("x") <= F.coalesce("hi", "x"))
    return split_join(values, brackets, "k", "inner", residual=at)


def _narrowed(values: DataFrame, brackets: DataFrame, slices: int) -> DataFrame:
    """One round: each bracket shrunk to the parts that hold its two order statistics."""
    near = _inside(values, brackets)
    probs = F.array(*[F.lit(s / slices) for s in range(1, slices)])
    cuts = near.groupBy("k", "i").agg(F.percentile_approx("x", probs, 16 * slices).alias("cuts"))
    part = F.size(F.filter("cuts", lambda s: s < F.col("x")))
    parts = (near.join(cuts, ["k", "i"]).groupBy("k", "i", part.alias("part"))
             .agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("rows"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                  F.first("pos").alias("pos"), F.first("below").alias("below")))
    before = Window.partitionBy("k", "i").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("first", F.col("below") + F.coalesce(F.sum("w").over(before), F.lit(0)))
    holds = (F.col("first") <= F.ceil("pos")) & (F.col("first") + F.col("w") > F.floor("pos"))
    return (parts.where(holds).groupBy("k", "i")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("first").alias("below"),
                 F.first("pos").alias("pos"), F.sum("rows").alias("rows")))


def _picked(ranked: DataFrame, by: list[str], pos: Column, *more: Column) -> DataFrame:
    """(by, q, more): the two order statistics around ``pos`` of rows (x, w = copies, last = rank of the last copy), interpolated."""
    first = F.col("last") - F.col("w") + 1
    at = lambda r: F.max(F.when((first <= r) & (r <= F.col("last")), F.col("x")))
    ends = ranked.groupBy(*by).agg(at(F.floor(pos)).alias("v0"), at(F.ceil(pos)).alias("v1"), F.max(pos).alias("pos"), *more)
    q = F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("pos") - F.floor("pos"))
    return ends.withColumn("q", q).drop("v0", "v1", "pos")


def exact_quantiles(df: DataFrame, c: str, probs, by: str | None = None, small: int | None = None,
                    slices: int | None = None) -> DataFrame:
    """(g, q): the exact interpolated quantiles of ``c`` (an array as long as ``probs``) per value of ``by``; NULL is a group like others.

    A group without values has no row; a table without values gives none.
    """
    small, slices = small or SMALL, slices or SLICES
    values, rows = value_counts(df, c, by)
    total = values.groupBy("k").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("rows"))
    wanted = F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("i", "p")
    pos = (F.col("p") * (F.col("n") - 1)).alias("pos")
    if rows <= small:                                             # so is every group: ordered as they are
        along = Window.partitionBy("k").orderBy("x")
        whole = Window.partitionBy("k")
        ranked = (values.withColumn("last", F.sum("w").over(along) - 1).withColumn("n", F.sum("w").over(whole))
                  .select("g", "k", "x", "w", "last", "n", wanted).select("g", "k", "x", "w", "last", "i", pos))
    else:
        brackets = written(total.select("k", "n", "rows", wanted)
                           .select("k", "i", F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
                                   F.lit(0).cast("long").alias("below"), pos, "rows"), "value_brackets")
        while brackets.agg(F.max("rows")).first()[0] > small:
            wide = _narrowed(values, brackets.where(F.col("rows") > small), slices)
            brackets = written(wide.unionByName(brackets.where(F.col("rows") <= small)), "value_brackets")
        along = Window.partitionBy("k", "i").orderBy("x")
        ranked = _inside(values, brackets).withColumn("last", F.col("below") + F.sum("w").over(along) - 1)
    ends = _picked(ranked, ["k", "i"], F.col("pos"), F.first("g", True).alias("g"))
    each = ends.groupBy("k").agg(F.first("g", True).alias("g"), F.array_sort(F.collect_list(F.struct("i", "q"))).alias("q"))
    return each.select("g", F.transform("q", lambda s: s["q"]).alias("q"))


def group_quantiles(df: DataFrame, c: str, p: float, by: str, method: str = "exact", accuracy: int = 100) -> DataFrame:
    """(g, q) per value of ``by``."""
    if method == "exact":
        return exact_quantiles(df, c, [p], by).select("g", F.col("q")[0].alias("q"))
    if method == "approx":
        return df.groupBy(F.col(by).alias("g")).agg(F.percentile_approx(c, p, accuracy).alias("q"))
    raise ValueError(f"unknown quantile method {method!r}")


def quantile_values(df: DataFrame, c: str, probs, method: str = "exact", accuracy: int = 100) -> list[Column]:
    """Quantiles of the whole column, one Column each: constants (``exact``, worked out now), or a scalar subquery."""
    if method == "exact":
        row = exact_quantiles(df, c, probs).first()               # one row
        return [F.lit(None if row is None else q).cast("double") for q in (row.q if row else [None] * len(probs))]
    if method == "approx":
        cuts = df.agg(F.percentile_approx(c, F.array(*[F.lit(float(p)) for p in probs]), accuracy).alias("q")).scalar()
        return [cuts[i] for i in range(len(probs))]
    raise ValueError(f"unknown quantile method {method!r}")
