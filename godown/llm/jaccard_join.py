"""N-gram Jaccard join with set-relation skipping (operator 9).

Sets are the distinct word shingles of a text.  Equal sets form a class and
go on as one representative.  The index holds, per shingle, the list of
representatives that have it in their prefix, with set size and position,
dealt into blocks by size.  Shingles are ordered by hash, with those that
are frequent in a sample of the documents last, so that prefixes avoid them
(the order changes the work, never the result).

Answers come in two passes.  First every set is compared with one
leader (the smallest id) of its block and of the neighbouring ones: a group of
near copies costs a pair per member, not all pairs.  Components of what is linked, with each
set's distance to the leader (or a lower bound of it, from the bitmaps), then
settle most other pairs unseen: sets of one component need no comparing, and
the distance being a metric, two sets whose distances to a common leader
differ by more than the threshold can't be linked.  Only what is left of the
lists is enumerated.  Long lists are cut into chunks, by component and
distance; two chunks meet in a join if they are not of one component and
sizes, positions and distances leave a pair open.  Candidates pass a
parity-bitmap filter (an exact lower bound of the symmetric difference) and
are then verified on whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from godown.llm.common import out_batch, passing, slices, written
from godown.llm.components import components
from godown.llm.words import mix, ngrams, word_hashes

SHINGLE = 5
PERCENT = 80
#: One document in SAMPLE (by a hash of its id) votes on which shingles are frequent.
SAMPLE = 16
#: Frequent: in at least this share of the sampled documents, and at least LEAST of them.
FREQUENT, LEAST = 1 / 2000, 3
#: Pairs of one document that are verified together.
TOGETHER = 256
#: Bits of the filter of wanted ids per id, and at most (8 MB): beyond that it lets more texts through.
FILTER_BITS, MOST_BITS = 8, 1 << 26
#: Pairs that a task remembers, so that it doesn't name them again.
SEEN = 1_000_000
#: Rows of a list that are compared at once; longer lists are cut into chunks of about so many rows.
BLOCK = 512
#: Pairs of rows that lists with one leader may bring into a task.
WORK = 1 << 26


def shingle_sets(batch, size: int = SHINGLE):
    """For each row its distinct shingles as sorted hashes; shorter texts are one shingle; no words, none."""
    h, cuts = word_hashes(batch, lower=True)
    grams = ngrams(h, size)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= size:
            yield np.unique(grams[a:b - size + 1])
        elif b > a:
            yield ngrams(h[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """So many first elements of a set must meet those of any set it is linked with."""
    return n - (percent * n + 99) // 100 + 1 if n else 0


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the elements in each of 2^k >= size cells (at least 64)."""
    bits = max(64, 1 << int(len(tokens) - 1).bit_length()) if len(tokens) else 64
    parity = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def bitmap_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference; the longer bitmap is folded onto the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def frequent_shingles(src: DataFrame) -> np.ndarray:
    """Sorted shingles from the sample, at most average set size / FREQUENT of them, rarest first."""
    def run(batches):
        for b in slices(batches):
            sets = list(shingle_sets(b.column(1)))
            yield out_batch(["s"], [np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)])

    sample = src.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("vote")), F.lit(SAMPLE)) == 0)
    n = sample.count()
    got = (sample.mapInArrow(run, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("df"))
           .where(F.col("df") >= max(LEAST, n * FREQUENT)).orderBy("df", "s").toArrow())
    return got.column("s").to_numpy().astype(np.int64).view(np.uint64)


def size_block(n: Column, percent: int = PERCENT) -> Column:
    """Number of a set's size block: linked sets are in the same or in neighbouring blocks."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.01 / percent))).cast("int")       # a little wider than the ratio of linked sizes


def enough(a: Column, b: Column, most: Column, percent: int = PERCENT) -> Column:
    """May sets of sizes a and b with an intersection of at most ``most`` be linked?"""
    return F.lit(100 + percent) * most >= F.lit(percent) * (a + b)


def described(src: DataFrame, percent: int, size: int) -> DataFrame:
    """doc_id, n, signature, bits, prefix of every document's set."""
    order = src.sparkSession.sparkContext.broadcast(frequent_shingles(src))

    def run(batches):
        common = order.value
        by = np.argsort(common)
        ranked = common[by]
        for b in slices(batches):
            n, sig_a, sig_b, bits, prefix = [], [], [], [], []
            for tokens in shingle_sets(b.column(1), size):
                k = prefix_length(len(tokens), percent)
                first = tokens
                if len(ranked) and len(tokens):
                    at = np.minimum(np.searchsorted(ranked, tokens), len(ranked) - 1)
                    known = ranked[at] == tokens
                    late = np.argsort(by[at[known]])
                    first = np.concatenate([tokens[~known], tokens[known][late]])
                n.append(len(tokens))
                sig_a.append(int(mix(tokens + np.uint64(17)).sum(dtype=np.uint64).view(np.int64)))
                sig_b.append(int(mix(tokens + np.uint64(71)).sum(dtype=np.uint64).view(np.int64)))
                bits.append(bitmap(tokens))
                prefix.append(first[:k].view(np.int64))
            yield out_batch(["doc_id", "n", "sig_a", "sig_b", "bits", "prefix"],
                            [b.column(0), pa.array(n, pa.int64()), pa.array(sig_a, pa.int64()), pa.array(sig_b, pa.int64()),
                             pa.array(bits, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))])

    return src.mapInArrow(run, "doc_id long, n long, sig_a long, sig_b long, bits binary, prefix array<long>")


def tested(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb, apart, close) for ``pairs`` (a, b): the bitmap's bound of the symmetric difference, and whether it leaves a link open."""
    def near(batches):
        for batch in batches:
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            d = np.array([bitmap_distance(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())], dtype=np.int64)
            # linked: |a ^ b| <= (1 - t) / (1 + t) (na + nb)
            ok = (100 + percent) * d <= (100 - percent) * (na + nb)
            yield out_batch(["a", "b", "na", "nb", "apart", "close"], [*(batch.column(i) for i in range(4)), d, ok])

    left = info.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    right = info.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    return written(pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "bits_a", "bits_b")
                   .mapInArrow(near, "a long, b long, na long, nb long, apart long, close boolean"), "jaccard_close", free=True)


def shared(one: np.ndarray, two: np.ndarray) -> int:
    """How many elements two sorted sets have in common."""
    if len(one) > len(two):
        one, two = two, one
    if not len(one):
        return 0
    at = np.minimum(np.searchsorted(two, one), len(two) - 1)
    return int((two[at] == one).sum())


def filter_places(ids: np.ndarray, bits: int) -> np.ndarray:
    """The bits that each id sets in a filter of ``bits`` bits."""
    ids = ids.astype(np.int64).view(np.uint64)
    return np.concatenate([mix(ids + np.uint64(salt)) & np.uint64(bits - 1) for salt in (17, 71)]).astype(np.int64)


def wanted(src: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``src`` that may have a doc_id of ``ids`` (distinct): all that have, and a few others.

    A Bloom filter is made of the ids, so that texts nobody asks for aren't
    shuffled to find that out.
    """
    bits = min(MOST_BITS, max(64, 1 << (FILTER_BITS * ids.count() - 1).bit_length()))

    def run(batches):
        for b in batches:
            at = filter_places(b.column(0).to_numpy(), bits)
            yield out_batch(["word", "bits"], [at >> 6, np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).view(np.int64)])

    got = ids.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    held = src.sparkSession.sparkContext.broadcast(words.view(np.uint64))

    @F.arrow_udf("boolean")
    def may(doc: pa.Array) -> pa.Array:
        at = filter_places(doc.to_numpy(zero_copy_only=False), bits)
        hit = (held.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return pa.array(hit.reshape(2, -1).all(axis=0))

    return src.where(may(F.coalesce("doc_id", F.lit(0).cast("long"))))


def verified(tests: DataFrame, src: DataFrame, size: int) -> DataFrame:
    """(a, b, na, nb, common) for the ``tests`` that are close; common counted on whole sets.

    Texts travel, not sets: they are a third of the size, and only those of
    some close pair.  The pairs of one
    document ``a`` are dealt over groups of about ``TOGETHER``, each with one
    copy of its text in front.
    """
    def compare(batches):
        own = np.zeros(0, np.uint64)                       # the set of the last row that is an `a`
        for batch in batches:
            for part in slices([batch]):
                out = [[] for _ in range(5)]
                cols = [part.column(i).to_pylist() for i in range(4)]
                for a, b, na, nb, tokens in zip(*cols, shingle_sets(part.column(4), size)):
                    if b is None:
                        own = tokens
                    else:
                        for c, v in zip(out, (a, b, na, nb, shared(own, tokens))):
                            c.append(v)
                yield out_batch(["a", "b", "na", "nb", "common"], [pa.array(c, pa.int64()) for c in out])

    close = tests.where("close").select("a", "b", "na", "nb")
    ids = written(close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "jaccard_wanted")
    whole = written(wanted(src, ids).join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")), "jaccard_texts", free=True)
    groups = written(close.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).cast("int").alias("groups")), "jaccard_groups")
    dealt = close.join(groups, "a").withColumn("group", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int")).drop("groups")
    theirs = dealt.join(whole.withColumnRenamed("doc_id", "b"), "b").select("a", "b", "na", "nb", "text", "group")
    none = F.lit(None).cast("long")
    own = (groups.join(whole.withColumnRenamed("doc_id", "a"), "a").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
           .select("a", none.alias("b"), none.alias("na"), none.alias("nb"), "text", "group"))
    both = own.unionByName(theirs).repartition("a", "group").sortWithinPartitions("a", "group", F.asc_nulls_first("b"))
    return written(both.select("a", "b", "na", "nb", "text").mapInArrow(compare, "a long, b long, na long, nb long, common long"),
                   "jaccard_verified", free=True)


def linked(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def open_cells(x, y, percent: int):
    """(a, b) of rows x and y (doc, n, pos, root, lo, hi) that sizes, positions, components and distances leave open."""
    far = 1 - percent / 100 + 1e-9
    for i in range(0, len(x[0]), BLOCK):
        doc, n, pos, root, lo, hi = (v[i:i + BLOCK, None] for v in x)
        for j in range(0, len(y[0]), BLOCK):
            doc_y, n_y, pos_y, root_y, lo_y, hi_y = (v[None, j:j + BLOCK] for v in y)
            most = np.minimum(n - pos, n_y - pos_y)
            ok = (root != root_y) & ((100 + percent) * most >= percent * (n + n_y))
            ok &= (lo_y - hi <= far) & (lo - hi_y <= far)
            p, q = np.nonzero(ok)
            one, two = doc[p, 0], doc_y[0, q]
            yield np.minimum(one, two), np.maximum(one, two)


def fresh_pairs(parts, seen: set):
    """Arrow batches of the pairs that aren't in ``seen``, which takes them in."""
    for a, b in parts:
        fresh = list({p for p in zip(a.tolist(), b.tolist()) if p[0] != p[1] and p not in seen})
        if len(seen) > SEEN:
            seen.clear()
        seen.update(fresh)
        if fresh:
            yield out_batch(["a", "b"], [np.array(c, np.int64) for c in zip(*fresh)])


def short_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of units that have at most BLOCK rows: a unit is compared as it is."""
    def done(parts, seen):
        cols = [np.concatenate(c) for c in zip(*parts)]
        home = ~cols[-1]
        yield from fresh_pairs(open_cells([c[home] for c in cols[:-1]], cols[:-1], percent), seen)

    def run(batches):
        carry: list = []
        seen: set = set()
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(i).to_numpy() for i in range(4)]                 # leader, bucket, token, unit
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4, 11)]
            cuts = [0, *(np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                key = tuple(k[i] for k in keys)
                if carry and key != last:
                    yield from done(carry, seen)
                    carry = []
                if last is None or key[:2] != last[:2]:
                    seen.clear()
                last = key
                carry.append([c[i:j] for c in cols])
        if carry:
            yield from done(carry, seen)

    # units of one passage have the same leader: dealt by it (and a bucket, if they are much work), a pair is named once for all of them
    return (rows.select("leader", "bucket", "token", "unit", "doc", "n", "pos", "root", "lo", "hi", "guest").repartition("leader", "bucket")
            .sortWithinPartitions("leader", "bucket", "token", "unit").mapInArrow(run, "a long, b long"))


def long_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of units with more than BLOCK rows, which are cut into chunks; two chunks that may hold a link meet in a join.

    A chunk has rows of like distance to the leader, either of one component
    or of components with less than BLOCK such rows.  Chunks of the same
    single component never meet.
    """
    far = 1 - percent / 100 + 1e-9
    unit = ["token", "unit", "guest", "band"]
    rows = rows.withColumn("band", F.floor(F.col("lo") * 20).cast("int"))
    pieces = lambda c: F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), c / BLOCK)))).cast("long")  # noqa: E731  alike for lists of like length
    sums = written(rows.groupBy(*unit, "root").agg(F.count(F.lit(1)).alias("c")), "jaccard_sums")
    large = sums.where(F.col("c") >= BLOCK).select(*unit, "root", pieces(F.col("c")).alias("own"))
    pool = sums.where(F.col("c") < BLOCK).groupBy(*unit).agg(pieces(F.sum("c")).alias("pool"))
    chunk = F.when(F.col("own").isNotNull(), F.xxhash64("band", "root", F.pmod(F.xxhash64("doc"), "own"))).otherwise(
        F.xxhash64("band", F.lit("pool"), F.pmod(F.xxhash64("root"), F.coalesce("pool", F.lit(1).cast("long")))))
    sides = (rows.join(large, [*unit, "root"], "left").join(pool, unit, "left").withColumn("chunk", chunk)
             .groupBy("token", "unit", "guest", "chunk")
             .agg(F.first("leader").alias("leader"), F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("n").alias("n0"), F.max("n").alias("n1"),
                  F.max(F.col("n") - F.col("pos")).alias("most"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                  F.collect_list(F.struct("doc", "n", "pos", "root", "lo", "hi")).alias("rows")))
    sides = written(sides, "jaccard_chunks")
    about = ["chunk", "guest", "r0", "r1", "n0", "n1", "most", "lo", "hi"]
    x = sides.where("not guest").select("token", "unit", "leader", *(F.col(c).alias("x_" + c) for c in about))
    y = sides.select("token", "unit", *(F.col(c).alias("y_" + c) for c in about))
    one = (F.col("x_r0") == F.col("x_r1")) & (F.col("y_r0") == F.col("y_r1")) & (F.col("x_r0") == F.col("y_r0"))
    meet = (x.join(y, ["token", "unit"]).where(F.col("y_guest") | (F.col("x_chunk") <= F.col("y_chunk"))).where(~one)
            .where((F.col("y_lo") - F.col("x_hi") <= far) & (F.col("x_lo") - F.col("y_hi") <= far))
            .where(enough(F.col("x_n0"), F.col("y_n0"), F.least("x_most", "y_most"), percent))
            .where((F.lit(percent) * F.col("x_n0") <= 100 * F.col("y_n1")) & (F.lit(percent) * F.col("y_n0") <= 100 * F.col("x_n1"))))
    meet = written(meet.select("token", "unit", "leader", "x_chunk", "y_chunk", "y_guest"), "jaccard_meet")
    full = (meet.join(sides.where("not guest").select("token", "unit", F.col("chunk").alias("x_chunk"), F.col("rows").alias("x")), ["token", "unit", "x_chunk"])
            .join(sides.select("token", "unit", F.col("chunk").alias("y_chunk"), F.col("guest").alias("y_guest"), F.col("rows").alias("y")),
                  ["token", "unit", "y_chunk", "y_guest"]))

    def side(col, k):
        part = col[k].values
        return [part.field(i).to_numpy() for i in range(6)]

    def run(batches):
        seen: set = set()
        last = None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for k, key in enumerate(keys):
                if key != last:
                    seen.clear()
                last = key
                yield from fresh_pairs(open_cells(side(batch.column(3), k), side(batch.column(4), k), percent), seen)

    # the same two chunks of several lists go to one task, which names a pair once
    return (full.select("leader", "x_chunk", "y_chunk", "x", "y").repartition("leader", "x_chunk", "y_chunk")
            .sortWithinPartitions("leader", "x_chunk", "y_chunk").mapInArrow(run, "a long, b long"))


def open_pairs(state: DataFrame, bounds: DataFrame, percent: int) -> DataFrame:
    """(a, b) of lists (token, block, doc, n, pos, root): pairs that sizes, positions, components and distances leave open.

    A unit is a size block of a list (home) with the next one (guests), so
    each two rows that may be linked meet in one unit as home and home or
    home and guest.  ``bounds`` (a, b, lo, hi) has what is known of the
    distance between a set and a leader, the smallest home of a unit.
    """
    of = lambda: F.explode(F.array(*(F.struct((F.col("block") - k).alias("unit"), F.lit(bool(k)).alias("guest")) for k in (0, 1)))).alias("at")
    blocks = state.groupBy("token", "block").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.min("doc").alias("first"), F.count(F.lit(1)).alias("c"))
    mixed = (blocks.select("token", of(), "x", "y", "first", "c").groupBy("token", F.col("at.unit").alias("unit"))
             .agg(F.min("x").alias("x"), F.max("y").alias("y"), F.max(F.when(~F.col("at.guest"), F.col("first"))).alias("leader"), F.sum("c").alias("c"))
             .where("x != y and leader is not null").select("token", "unit", "leader", "c"))
    mixed = written(mixed, "jaccard_mixed")
    work = (mixed.where(F.col("c") <= BLOCK).groupBy("leader").agg(F.ceil(F.sum(F.col("c") * F.col("c")) / WORK).alias("tasks")))
    mixed = mixed.join(work, "leader", "left").withColumn("bucket", F.pmod(F.xxhash64("token"), F.coalesce("tasks", F.lit(1).cast("long")))).drop("tasks")
    rows = (state.select("token", of(), "doc", "n", "pos", "root").select("token", "at.unit", "at.guest", "doc", "n", "pos", "root")
            .join(mixed, ["token", "unit"]).withColumn("a", F.least("doc", "leader")).withColumn("b", F.greatest("doc", "leader")).join(bounds, ["a", "b"], "left"))
    known = lambda c, other: F.when(F.col("doc") == F.col("leader"), 0.0).otherwise(F.coalesce(c, F.lit(other))).alias(c)
    rows = written(rows.select("leader", "bucket", "token", "unit", "c", "doc", "n", "pos", "root", known("lo", 0.0), known("hi", 1.0), "guest"), "jaccard_units")
    pairs = short_pairs(rows.where(F.col("c") <= BLOCK), percent)
    if mixed.where(F.col("c") > BLOCK).isEmpty():
        return pairs.distinct()
    return pairs.unionByName(long_pairs(rows.where(F.col("c") > BLOCK), percent)).distinct()


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, class_id: one row per row of ``docs``.

    Linked: 100 |a & b| >= percent |a | b|.  Texts with fewer words than a
    shingle are one shingle; null text and text without words has an empty
    set, linked with nothing.  Rows that repeat an id share its component.
    Ids are integers.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with passing(docs.sparkSession) as tables:
        members = written(member_components(src, percent, size), "jaccard_members")
        tables.pop()                                       # the members stay
    return members


def member_components(src: DataFrame, percent: int, size: int) -> DataFrame:
    """What ``jaccard_components`` returns, for ``src`` (doc_id, text); it reads tables written on the way."""
    info = written(described(src, percent, size), "jaccard_info")
    classes = (info.where("n > 0").groupBy("sig_a", "sig_b", "n").agg(F.min("doc_id").alias("class_id")))
    classes = written(classes, "jaccard_classes")
    own = info.where("n > 0").join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    reps = written(own.select("doc_id", "n", "bits"), "jaccard_reps")
    posts = (own.select("doc_id", "n", F.posexplode("prefix").alias("pos", "token"))
             .select("token", F.col("doc_id").alias("doc"), "n", F.col("pos").cast("long").alias("pos"), size_block(F.col("n"), percent).alias("block")))
    counts = posts.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    posts = written(posts.join(written(counts, "jaccard_tokens", free=True), "token"), "jaccard_lists", free=True)
    # pass 1: every set with the leaders of its blocks and the neighbouring ones
    leaders = posts.groupBy("token", "block").agg(F.min(F.struct("doc", "n", "pos")).alias("l"))
    leaders = written(leaders.select("token", F.explode(F.array(*[F.col("block") + k for k in (-1, 0, 1)])).alias("block"), "l"), "jaccard_leaders")
    most = F.least(F.col("n") - F.col("pos"), F.col("l.n") - F.col("l.pos"))
    star = (posts.join(leaders, ["token", "block"]).where((F.col("doc") != F.col("l.doc")) & enough(F.col("n"), F.col("l.n"), most, percent))
            .select(F.least("doc", "l.doc").alias("a"), F.greatest("doc", "l.doc").alias("b")).distinct())
    star = written(star, "jaccard_star", free=True)
    tests = tested(star, reps, percent)
    found = verified(tests, src, size)
    links = linked(found, percent)
    roots = components(links)
    # distances to leaders: exact ones, and for pairs that the bitmaps tell apart |a ^ b| / |a | b| from their bound of |a ^ b|
    dist = 1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    least = 2 * F.col("apart") / (F.col("na") + F.col("nb") + F.col("apart"))
    bounds = (found.select("a", "b", dist.alias("lo"), dist.alias("hi"))
              .unionByName(tests.where("not close").select("a", "b", least.alias("lo"), F.lit(1.0).alias("hi"))))
    # pass 2: what is left of lists that still hold more than one component
    state = posts.join(roots.withColumnRenamed("node", "doc"), "doc", "left").select("token", "block", "doc", "n", "pos", F.coalesce("root", "doc").alias("root"))
    state = written(state, "jaccard_state", free=True)
    rest = open_pairs(state, written(bounds, "jaccard_bounds"), percent).join(star, ["a", "b"], "left_anti")
    again = verified(tested(written(rest, "jaccard_rest"), reps, percent), src, size)
    roots = components(links.unionByName(linked(again, percent)))

    member = (info.select("doc_id", "n", "sig_a", "sig_b").join(classes, ["sig_a", "sig_b", "n"], "left")
              .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left"))
    return member.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "class_id", "doc_id").alias("component_id"),
                         F.coalesce("class_id", "doc_id").alias("class_id"))

