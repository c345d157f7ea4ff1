"""I-Match fingerprints on randomised lexicons (operator 7); DataFrame functions only.

Terms (lower-case runs of letters and digits) are hashed and fall into
``SLOTS`` classes.  The lexicon holds the classes whose document frequency,
counted over all documents, lies in a band.  A text keeps its distinct terms
inside the lexicon, sorted; each of several random sub-lexicons keeps some of
them, and the hash of what it keeps is one entry of the fingerprint.
Sub-lexicons come at several rates, so that texts of all lengths have
entries of one or two terms, and an edit leaves some entries alone.  The
number of classes is fixed, so the lexicon travels as a constant of
``SLOTS`` bits whatever the vocabulary.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 1 << 20
#: Document frequency band, as shares of all documents; at least two documents.
BAND = (0.0005, 0.05)
#: (bits, draws): sub-lexicons that keep a term with probability 2^-bits; each draw looks at bits of its own.
RATES = ((0, 1), (2, 2), (4, 6), (5, 6), (6, 6), (7, 6), (8, 6))
DRAW_BITS = 10
#: Upper ends of wider bands, as multiples of the band's: a text with too few terms in one takes the next, and all its terms after the last.
WIDER = (2, 4, 8, 16)
#: Too few: less than LEAST terms, or than this share of the text's terms.
LEAST, LEAST_SHARE = 16, 1 / 8
MOST_BUCKETS = 50_000
TERM_BREAK = r"[^\p{L}\p{N}]+"


def term_hashes(text: Column) -> Column:
    """The distinct terms of a text as 64-bit hashes."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), TERM_BREAK), lambda t: t != "")
    return F.array_distinct(F.transform(words, lambda t: F.xxhash64(t)))


def slot(h: Column) -> Column:
    return F.pmod(h, F.lit(SLOTS)).cast("int")


def lexicons(docs: DataFrame, text_col: str = "text", band=BAND, wider=WIDER) -> list[list[int]]:
    """A lexicon for the band and one for each wider band: a bit per class, in 64-bit words, set if the class's document frequency lies in it."""
    n = docs.count()
    low, high = max(2, math.ceil(band[0] * n)), [max(2, math.floor(m * band[1] * n)) for m in (1, *wider)]
    classes = F.array_distinct(F.transform(term_hashes(F.col(text_col)), slot))
    kept = (docs.select(F.explode(classes).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"))
            .where(F.col("df").between(low, high[-1])).select("s", "df"))
    bit = F.expr("shiftleft(1L, s % 64)")
    words = (kept.groupBy((F.col("s") / 64).cast("int").alias("w"))
             .agg(*(F.bit_or(F.when(F.col("df") <= h, bit).otherwise(F.lit(0).cast("long"))).alias(f"bits{i}") for i, h in enumerate(high)))
             .collect())                                                   # at most SLOTS / 64 rows
    out = [[0] * (SLOTS // 64) for _ in high]
    for r in words:
        for i, lex in enumerate(out):
            lex[r["w"]] = r[f"bits{i}"]
    return out


def lexicon(docs: DataFrame, text_col: str = "text", band=BAND) -> list[int]:
    """The band's lexicon alone."""
    return lexicons(docs, text_col, band, ())[0]


def in_lexicon(h: Column, bits: Column) -> Column:
    return F.getbit(F.get(bits, (slot(h) / 64).cast("int")), slot(h) % 64) == 1


def sub_lexicon(bits: int, draw: int):
    mask = F.lit((1 << bits) - 1).cast("long")
    return lambda h: F.shiftrightunsigned(h, DRAW_BITS * draw).bitwiseAND(mask) == 0


def entries(text_terms: Column, kept: Column) -> Column:
    """The fingerprint: a hash per sub-lexicon, null where it keeps no term.

    Without any term in the lexicon the first entry hashes all terms.
    """
    out = [F.when(F.size(kept) > 0, F.xxhash64(kept)).otherwise(F.xxhash64(F.array_sort(text_terms), F.lit("all")))]
    for bits, draws in RATES[1:]:
        for d in range(draws):
            some = F.filter(kept, sub_lexicon(bits, d))
            out.append(F.when(F.size(some) > 0, F.xxhash64(some)))
    return F.array(*out)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among those that either fingerprint has."""
    same = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), x.eqNullSafe(y)))
    return F.size(F.filter(same, lambda x: x)) / F.size(F.filter(same, lambda x: x.isNotNull()))


def as_string(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lower(F.hex(x))), ".", "-")


def fingerprints(docs: DataFrame, lex: list, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``fp``; equal texts have equal fingerprints, null counts as empty.

    With ``lexicons`` a text that has too few terms in the band takes those
    of the first wider band that holds enough, or all, so a group of copies
    that lifts its own terms out of the band keeps its entries.
    """
    nested = lex if lex and isinstance(lex[0], list) else [lex]
    inside = lambda x: F.filter("_terms", lambda h: in_lexicon(h, F.from_json(F.lit(json.dumps(x)), "array<bigint>")))  # noqa: E731  folded to a constant
    rows = docs.withColumn("_terms", term_hashes(F.col(text_col))).withColumn("_band", inside(nested[0]))
    kept = F.col("_band")
    if len(nested) > 1:
        need = F.greatest(F.lit(float(LEAST)), F.size("_terms") * F.lit(LEAST_SHARE))
        kept = F.col("_terms")
        for wide in [*map(inside, nested[:0:-1]), F.col("_band")]:
            kept = F.when(F.size(wide) >= need, wide).otherwise(kept)
    rows = rows.withColumn("_kept", F.array_sort(kept))
    return rows.withColumn("fp", entries(F.col("_terms"), F.col("_kept"))).drop("_terms", "_band", "_kept")


def id_buckets(docs: DataFrame, n: int) -> Column:
    """A bucket number that grows with ``doc_id``, of about n even buckets (null ids in the first)."""
    width = max(2, math.isqrt(n) + 1)
    probs = [(i + 1) / (width * width) for i in range(width * width - 1)]
    cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", probs, max(10_000, 4 * len(probs))).alias("c")).first()["c"] or []))
    rows = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    tops = F.from_json(F.lit(json.dumps([r[-1] for r in rows])), "array<bigint>")
    fine = F.from_json(F.lit(json.dumps([*rows, []])), "array<array<bigint>>")
    k = F.size(F.filter(tops, lambda c: c < F.col("doc_id")))
    return F.coalesce(k * width + F.size(F.filter(F.get(fine, k), lambda c: c < F.col("doc_id"))), F.lit(0))


def edited_fingerprints(docs: DataFrame, lex: list[int], id_col: str = "doc_id", text_col: str = "text",
                        band_buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    One row per row; null text counts as empty.  Documents follow each other
    by id, rows with equal ids by text; after the last comes the first.  Ids
    are integers.  Rows are range-bucketed by id, and each bucket also gets
    the first row of the next one, so no window spans the table.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = band_buckets or min(MOST_BUCKETS, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucketed = src.withColumn("bucket", id_buckets(src, parts))
    heads = bucketed.groupBy("bucket").agg(F.min("doc_id").alias("head"), F.max(F.col("doc_id").isNull()).alias("nulls"))
    heads = [(r["bucket"], None if r["nulls"] else r["head"]) for r in heads.orderBy("bucket").collect()]   # a row per bucket
    spark = docs.sparkSession
    after = [(heads[(i + 1) % len(heads)][1], b) for i, (b, _) in enumerate(heads)]
    guests = spark.createDataFrame([(h, b) for h, b in after] or [], "head long, guest int")
    rows = bucketed.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("head")), "left")
    # a bucket's head is also the guest of the bucket before it
    spread = rows.select("doc_id", "text", F.explode(F.array(
        F.struct(F.col("bucket").alias("b"), F.lit(0).alias("guest")),
        F.struct(F.col("guest").alias("b"), F.lit(1).alias("guest")))).alias("at")).where("at.b is not null")
    spread = spread.select("doc_id", "text", F.col("at.b").alias("bucket"), F.col("at.guest").alias("guest"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = (spread.withColumn("next", F.lead("text").over(order)).withColumn("at", F.row_number().over(order))
             .withColumn("n_chars", n.cast("long"))
             .withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half))))
    both = fingerprints(pairs, lex).withColumnRenamed("fp", "own")
    both = fingerprints(both.withColumn("edited_sha256", F.sha2("edited", 256)), lex, "edited").drop("text", "edited", "next")
    following = Window.partitionBy("bucket").orderBy("at")
    return (both.withColumn("next", F.lead("own").over(following)).where("guest = 0")
            .select("doc_id", "n_chars", "edited_sha256", as_string(F.col("own")).alias("fingerprint"),
                    as_string(F.col("fp")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("fp")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next")))
