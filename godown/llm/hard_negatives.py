"""Hard-negative mining (operator 11): LEMP-style coordinate pruning of inner products.

Vectors become integers floor(scale * x); a score is an integer inner
product.  Rows are dealt into length buckets (lengths within a factor of
``1 + WIDTH``) and these into shards of about ``SHARD`` rows by a hash of
the id.  The anchors are dealt into blocks of about ``BLOCK``; a cell of the
grid is a shard with a block, so neither side of a task grows with the
tables, whatever a label, a length or a group of copies holds.

In a cell every coordinate of the shard's unit vectors is sorted once.  An
anchor with least useful score t needs cosines of at least
c = t / (|anchor| * longest length).  For a coordinate f of a unit anchor a,
such a vector v has v_f within  a_f * c  +-  sqrt((1 - a_f^2) * (1 - c^2))
(up to 1 if a_f >= c, down to -1 if a_f <= -c), so each focus coordinate (those where the anchor is largest) gives a
stretch of its sorted list, and only vectors in all of the stretches are
candidates; shards that are too short give none.  Candidates are scored
exactly, in integers (or doubles that hold them exactly).

Bounds t come from a fixed number of rows (``SEED``): an anchor's k-th best
score among them can't be above its k-th best among all.  They only save
work.  First the positives are found that way among rows of the anchor's
label (in shards of one label), then for all positives of an anchor at once
the best negatives inside their score windows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from godown.llm.common import written

WIDTH = 0.1
SHARD = 8192
BLOCK = 2048
SEED = 2048
SEED_VALUES = 1 << 18
FOCUS = 4
#: Anchors whose scores with a shard are held at once.
SLICE = 256
#: Squared lengths from here on could overflow a long in an inner product.
TOO_LONG = float(1 << 62)
EPS = 1e-9
#: Below every score.
NONE = -(1 << 62)


def integer_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 scale: int = 256, relabel=None) -> DataFrame:
    """vec_id, label, v (array of long) of the rows that take part, one per id.

    Without: rows with a null id, label or vector, a null or non-finite
    component, or whose squared integer length reaches 2^62 (their scores
    might not fit).  Of rows with the same id the first by label, then vector
    stays.  Vectors of different lengths count as padded with zeros.
    """
    label = F.col("label") if relabel is None else relabel(F.col("vec_id"), F.col("label"))
    x = F.transform("v", lambda c: F.floor(F.lit(scale).cast("double") * c))
    big = F.aggregate("v", F.lit(0.0), lambda s, c: s + F.pow(F.floor(F.lit(float(scale)) * c), F.lit(2.0)))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    got = (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"))
           .where("vec_id is not null and label is not null and v is not null").where(fine).where(big < TOO_LONG)
           .select("vec_id", label.alias("label"), x.cast("array<bigint>").alias("v")))
    return got.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


def numbered(rows: DataFrame, kin) -> DataFrame:
    """Adds kin and shard: rows of one kin and length bucket, dealt by a hash of the id, numbered from 0 in each kin.

    Squared lengths stay below 2^62, so a kin has at most 227 buckets.
    Returns the rows; the second frame has the number of shards per kin.
    """
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    bucket = F.when(length > 0, F.floor(F.log(length) / math.log1p(WIDTH))).otherwise(-1).cast("int")
    rows = rows.withColumn("kin", kin).withColumn("bucket", bucket)
    parts = F.ceil(F.count(F.lit(1)) / SHARD).cast("long")
    before = Window.partitionBy("kin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(rows.groupBy("kin", "bucket").agg(parts.alias("parts"))
                     .withColumn("first", F.coalesce(F.sum("parts").over(before), F.lit(0))), "negative_buckets")
    shard = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    return (rows.join(counts, ["kin", "bucket"]).select("kin", shard.alias("shard"), "vec_id", "label", "v"),
            counts.groupBy("kin").agg(F.sum("parts").alias("shards")))


def lists(column) -> pa.ListArray:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def matrix(column, width: int) -> np.ndarray:
    """Rows of a list column as integers, padded with zeros to ``width``."""
    column = lists(column)
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), dtype=np.int64)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def width_of(*columns) -> int:
    return max([1, *(int(np.diff(np.asarray(lists(c).offsets)).max()) for c in columns if len(c))])


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in integers, by doubles where all partial sums stay below 2^53."""
    most = math.sqrt(float((a.astype(float) ** 2).sum(1).max(initial=0)) * float((b.astype(float) ** 2).sum(1).max(initial=0)))
    if most < 2.0 ** 52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


class Shard:
    """Sorted coordinate lists of a shard's unit vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        lengths = np.sqrt((vectors.astype(float) ** 2).sum(1))
        self.longest = float(lengths.max(initial=0.0))
        unit = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").T.copy()
        self.lists = np.take_along_axis(unit, self.order.T, 0).T.copy()

    def candidates(self, anchor: np.ndarray, least: float) -> np.ndarray | None:
        """Rows that may score ``least`` or more with ``anchor``; None for all."""
        length = math.sqrt(float((anchor.astype(float) ** 2).sum()))
        if least <= 0:
            return None
        if length * self.longest * (1 + EPS) < least:
            return np.zeros(0, np.int64)
        unit, c = anchor / length, min(1.0, least / (length * self.longest))
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        slack = np.sqrt(np.maximum(0.0, (1 - unit[focus] ** 2) * (1 - c * c))) + EPS
        n = len(self.vectors)
        spans = []
        for f, d in zip(focus.tolist(), slack.tolist()):
            low = -1.0 - EPS if unit[f] <= -c else unit[f] * c - d         # e_f or its opposite lies within the angle
            high = 1.0 + EPS if unit[f] >= c else unit[f] * c + d
            lo, hi = int(np.searchsorted(self.lists[f], low)), int(np.searchsorted(self.lists[f], high, side="right"))
            spans.append((hi - lo, f, lo, hi))
        spans = sorted(x for x in spans if x[0] < n)
        if not spans or spans[0][0] > 0.7 * n:
            return None
        hits = np.zeros(n, np.int8)
        for _, f, lo, hi in spans:
            hits[self.order[f, lo:hi]] += 1
        return np.flatnonzero(hits == len(spans))


def scored(shard: Shard, anchors: np.ndarray, least: np.ndarray):
    """(anchor row, shard rows, scores) for each anchor that has candidates; every score of at least ``least`` is there."""
    for a in range(0, len(anchors), SLICE):
        part = anchors[a:a + SLICE]
        some = [shard.candidates(v, t) for v, t in zip(part, least[a:a + SLICE])]
        every = [k for k, s in enumerate(some) if s is None]
        if every:
            products = exact_products(part[every], shard.vectors)
            for j, k in enumerate(every):
                yield a + k, None, products[j]
        for k, s in enumerate(some):
            if s is not None and len(s):
                yield a + k, s, exact_products(part[k:k + 1], shard.vectors[s])[0]


def first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, best first, ties by smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= cut)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def windows(positives: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Integer bounds of ``low * p <= 100 * n <= high * p``."""
    return -((-low * positives) // 100), (high * positives) // 100


def grid(rows: DataFrame, anchors: DataFrame, kin, fn, schema: str) -> DataFrame:
    """``fn(shard table, anchor table)`` for each shard and block of anchors of one kin.

    The stated anchors meet all rows of their kin, in blocks: a side is
    repeated once per block or shard of the other, and a cell holds at most
    about ``SHARD`` rows and ``BLOCK`` anchors.
    """
    rows, shards = numbered(rows, kin)
    anchors = anchors.withColumn("kin", kin)
    blocks = written(anchors.groupBy("kin").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks")),
                     "negative_blocks")
    dealt = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    cell = ["kin", "shard", "block"]
    left = rows.join(blocks, "kin").withColumn("block", dealt("blocks")).select(*cell, "vec_id", "label", "v")
    right = (anchors.join(blocks, "kin").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
             .join(shards, "kin").withColumn("shard", dealt("shards")).select(*cell, *[c for c in anchors.columns if c != "kin"]))
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(fn, schema)


def seed_rows(rows: DataFrame) -> tuple[np.ndarray, list, np.ndarray]:
    """ids, labels and vectors of at most SEED rows (fewer if wide), chosen by a hash of the id."""
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    got = rows.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(max(16, min(SEED, SEED_VALUES // max(1, width)))).toArrow()
    return got["vec_id"].to_numpy(), got["label"].to_pylist(), matrix(got["v"], max(1, width))


def as_wide(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m[:, :width]


def top_positives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """anchor_id, positive_id, score: each anchor's k best other rows of its label."""
    ids, labels, seeds = seed_rows(rows)
    labels = np.array(labels, dtype=object)

    def bounded(batches):
        for batch in batches:
            a_ids, a_labels = batch.column(0).to_numpy(zero_copy_only=False), np.array(batch.column(1).to_pylist(), dtype=object)
            m = matrix(batch.column(2), max(seeds.shape[1], width_of(batch.column(2))))
            products = exact_products(m, as_wide(seeds, m.shape[1]))
            least = np.full(len(m), NONE)
            for i in range(len(m)):
                own = np.sort(products[i][(labels == a_labels[i]) & (ids != a_ids[i])])[::-1]
                if len(own) >= k:
                    least[i] = own[k - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=["vec_id", "label", "v", "least"])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            width = width_of(left["v"], right["v"])
            own, a_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            least = right["least"].to_numpy()
            for i, at, scores in scored(Shard(matrix(left["v"], width)), matrix(right["v"], width), least):
                there = own if at is None else own[at]
                ok = (scores >= least[i]) & (there != a_ids[i])
                there, scores = there[ok], scores[ok]
                best = first(there, scores, k)
                out[0].append(np.full(len(best), a_ids[i]))
                out[1].append(there[best])
                out[2].append(scores[best])
        return pa.table([np.concatenate([np.zeros(0, np.int64), *x]) for x in out], names=["anchor_id", "positive_id", "score"])

    ready = anchors.select("vec_id", "label", "v")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ready.schema)
    found = grid(rows, ready.mapInArrow(bounded, kinds + ", least bigint"), F.col("label"), search,
                 "anchor_id bigint, positive_id bigint, score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` as from ``integer_rows``; ``anchors`` is some of them.  For each
    anchor and each of its first ``positives`` other rows of the same label,
    the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.
    Higher scores come first, ties by smaller vec_id.  An anchor without
    positives or a positive whose window is empty gives no rows; empty
    tables give none.
    """
    best = written(top_positives(rows, anchors, positives), "negative_positives")
    ids, labels, seeds = seed_rows(rows)
    labels = np.array(labels, dtype=object)
    grouped = best.groupBy("anchor_id").agg(F.collect_list(F.struct("place", "positive_id", "score")).alias("p"))
    wanted = (anchors.join(grouped, F.col("vec_id") == F.col("anchor_id"))
              .select("vec_id", "label", "v", F.col("p.positive_id").alias("positive_id"), F.col("p.score").alias("score")))

    def bounded(batches):
        for batch in batches:
            a_labels = np.array(batch.column(1).to_pylist(), dtype=object)
            m = matrix(batch.column(2), max(seeds.shape[1], width_of(batch.column(2))))
            products = exact_products(m, as_wide(seeds, m.shape[1]))
            least, most = [], []
            for i, scores in enumerate(batch.column(4)):
                lo, hi = windows(np.array(scores.as_py(), np.int64), low, high)
                other = np.sort(products[i][labels != a_labels[i]])[::-1]
                for j in range(len(lo)):
                    inside = other[(other >= lo[j]) & (other <= hi[j])]
                    if len(inside) >= negatives:
                        lo[j] = inside[negatives - 1]
                least.append(lo)
                most.append(hi)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.list_(pa.int64())), pa.array(most, pa.list_(pa.int64()))],
                                             names=["vec_id", "label", "v", "positive_id", "score", "least", "most"])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            width = width_of(left["v"], right["v"])
            own, a_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            names = {x: i for i, x in enumerate(pa.compute.unique(left["label"]).to_pylist())}
            label = np.array([names[x] for x in left["label"].to_pylist()])
            a_label = [names.get(x, -1) for x in right["label"].to_pylist()]
            lows, highs, p_ids, p_scores = (right[c].to_pylist() for c in ("least", "most", "positive_id", "score"))
            open_ = [[j for j in range(len(lo)) if lo[j] <= hi[j]] for lo, hi in zip(lows, highs)]
            least = np.array([min((lo[j] for j in js), default=-NONE) for lo, js in zip(lows, open_)])
            for i, at, scores in scored(Shard(matrix(left["v"], width)), matrix(right["v"], width), least):
                there, kind = (own, label) if at is None else (own[at], label[at])
                ok = (scores >= least[i]) & (kind != a_label[i])
                there, scores = there[ok], scores[ok]
                for j in open_[i]:
                    inside = np.flatnonzero((scores >= lows[i][j]) & (scores <= highs[i][j]))
                    mine = inside[first(there[inside], scores[inside], negatives)]
                    for x, y in zip(out, (np.full(len(mine), a_ids[i]), np.full(len(mine), p_ids[i][j]), there[mine],
                                          np.full(len(mine), p_scores[i][j]), scores[mine])):
                        x.append(y)
        return pa.table([np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in out],
                        names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema)
    found = grid(rows, wanted.mapInArrow(bounded, kinds + ", least array<bigint>, most array<bigint>"), F.lit(0), search,
                 "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
