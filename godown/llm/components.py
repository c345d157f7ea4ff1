"""Connected components of a distributed edge table by min-hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that isn't the smallest of its component.

    Each round every node hooks to its smallest neighbour if that is smaller,
    pointers jump to the root, and the edges shrink to edges between roots,
    until none is left.  Minima are pre-aggregated per task, so a hub costs
    one row per task; joins have plain shuffled inputs, so adaptive execution
    splits a hub's rows.  Every step is written, so a lost executor repeats
    one step only.  Null ends and loops are ignored.
    """
    e = written(edges.where("a is not null and b is not null and a != b")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc_edges")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false")
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = written(both.groupBy("a").agg(F.min("b").alias("p")).where("p < a"), "cc_hook")
        moved = True
        while moved:
            to = hook.select(F.col("a").alias("p"), F.col("p").alias("up"))
            jump = written(hook.join(to, "p", "left").select("a", F.coalesce("up", "p").alias("p"),
                                                             F.col("up").isNotNull().alias("moved")), "cc_jump")
            moved = not jump.where("moved").isEmpty()
            hook = jump.select("a", "p")
        to = hook.select(F.col("a").alias("root"), F.col("p").alias("up"))
        found = written(found.join(to, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
                        .unionByName(hook.select(F.col("a").alias("node"), F.col("p").alias("root"))), "cc_found")
        e = (e.join(to.withColumnRenamed("root", "a"), "a", "left").select(F.coalesce("up", "a").alias("a"), "b")
             .join(to.withColumnRenamed("root", "b"), "b", "left").select("a", F.coalesce("up", "b").alias("b")))
        e = written(e.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc_edges")
    return found
