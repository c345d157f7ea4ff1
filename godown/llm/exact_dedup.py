"""Exact dedup by streaming state (operator 10).

Texts are equal when they are identical after each run of ASCII white space
becomes one space.  A file stream of (digest, id, content locator) feeds
keyed state on disk (RocksDB under the stream's checkpoint): per digest the
smallest id, that row's locator and the number of rows.  State never
expires, so a delivery that arrives later is deduplicated against all
earlier ones.  Rows are pre-aggregated before they reach the state, so a
digest that a third of all rows share costs one row per task.

Digest hits are checked on full bytes: the texts of every digest with more
than one row meet, and the smallest and largest text must be the same
string.  Digests where they differ (collisions) are regrouped by the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from godown.llm.common import written
from godown.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
#: State on disk; without reserved space, as there are many small stores.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: A digest is hot from this share of all rows on; so at most 1/HOT_SHARE digests are.
HOT_SHARE = 0.001
SALTS = 64


def normalised(text):
    """Null counts as empty; each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def in_files(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows come straight from files, else written to the shared folder and read again: each row has a file and a number."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
        return docs
    except AnalysisException:
        return written(docs, "dedup_rows")


def locator():
    return F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("locator")


def with_locator(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, locator) of rows read from files; the locator is file and row."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), locator())


def digest_feed(docs: DataFrame, digest) -> DataFrame:
    return docs.select("doc_id", "locator", digest(normalised(F.col("text"))).alias("digest"))


def stream_state(spark: SparkSession, feed_path: str, schema: T.StructType, checkpoint: str,
                 files_per_trigger: int = 1000) -> DataFrame:
    """Bring the state under ``checkpoint`` up to date with all files of ``feed_path``; read it.

    Calling it again after more files have arrived continues from the
    checkpoint.  Returns digest, keep_id, keep_locator, group_size.
    """
    keep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")).alias("keep")
    feed = (spark.readStream.schema(schema).option("maxFileAge", "36500d")
            .option("maxFilesPerTrigger", files_per_trigger).parquet(feed_path))
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        q = (feed.groupBy("digest").agg(keep, F.count(F.lit(1)).alias("group_size"))
             .writeStream.format("noop").outputMode("update").trigger(availableNow=True)
             .option("checkpointLocation", checkpoint).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    state = spark.read.format("statestore").load(checkpoint)
    value = [f.name for f in state.schema["value"].dataType.fields]   # the two buffers, in order
    return state.select(F.col("key.digest").alias("digest"),
                        F.col(f"value.{value[0]}.doc_id").alias("keep_id"),
                        F.col(f"value.{value[0]}.locator").alias("keep_locator"),
                        F.col(f"value.{value[1]}").alias("group_size"))


def collisions(docs: DataFrame, groups: DataFrame, digest) -> DataFrame:
    """Digests under which texts with different bytes meet."""
    total = groups.agg(F.sum("group_size").alias("t"))
    repeated = groups.where("group_size > 1").select("digest", "group_size")
    floor = total.first()["t"] or 0
    hot = repeated.where(F.col("group_size") >= max(2.0, HOT_SHARE * floor)).select("digest", F.lit(True).alias("hot"))
    texts = docs.select("locator", normalised(F.col("text")).alias("t")).withColumn("digest", digest(F.col("t")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("locator"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    # at most 1 / HOT_SHARE rows: a proven bound for the broadcast
    texts = texts.join(F.broadcast(hot), "digest", "left").withColumn("salt", salt).select("digest", "salt", "t")
    keys = (repeated.join(F.broadcast(hot), "digest", "left")
            .select("digest", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
                                        .otherwise(F.array(F.lit(0).cast("long")))).alias("salt")))
    ends = (texts.join(keys, ["digest", "salt"]).groupBy("digest", "salt").agg(F.min("t").alias("a"), F.max("t").alias("b"))
            .groupBy("digest").agg(F.min("a").alias("a"), F.max("b").alias("b")))
    return ends.where("a != b").select("digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=None,
                files_per_trigger: int = 1000) -> DataFrame:
    """doc_id, locator, keep_id, keep_locator, group_size, kept, digest: one row per row of ``docs``.

    Null text counts as empty.  The row with the smallest id of a group
    stays; between rows with the same id the smaller locator; a null id
    comes last.  Extra columns of ``docs`` don't matter.  An empty table
    gives an empty result.  ``digest`` maps a text column to a digest
    column (default sha-256 hex).
    """
    spark = docs.sparkSession
    digest = digest or (lambda c: F.sha2(c, 256))
    rows = with_locator(in_files(docs), id_col, text_col)
    path = scratch_path(spark, "llm", "dedup_feed")
    schema = digest_feed(rows, digest).schema
    digest_feed(rows, digest).write.parquet(path)
    feed = spark.read.schema(schema).parquet(path)
    if feed.isEmpty():
        return feed.select("doc_id", "locator", F.col("doc_id").alias("keep_id"), F.col("locator").alias("keep_locator"),
                           F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    groups = written(stream_state(spark, path, schema, scratch_path(spark, "llm", "dedup_state"), files_per_trigger),
                     "dedup_groups")
    bad = written(collisions(rows, groups, digest), "dedup_collisions")
    out = ["doc_id", "locator", "keep_id", "keep_locator", "group_size", "digest"]
    if bad.isEmpty():
        found = feed.join(groups, "digest").select(*out)
    else:
        again = (rows.withColumn("t", normalised(F.col("text"))).withColumn("digest", digest(F.col("t")))
                 .join(bad, "digest", "left_semi"))
        first = again.groupBy("digest", "t").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "locator")).alias("k"),
                                                 F.count(F.lit(1)).alias("group_size"))
        split = (again.join(first, ["digest", "t"])
                 .select("doc_id", "locator", F.col("k.doc_id").alias("keep_id"), F.col("k.locator").alias("keep_locator"),
                         "group_size", "digest"))
        found = feed.join(bad, "digest", "left_anti").join(groups, "digest").select(*out).unionByName(split)
    return found.withColumn("kept", F.col("locator") == F.col("keep_locator"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, all columns as they were."""
    docs = in_files(docs)
    kept = written(exact_dedup(docs, id_col, text_col).where("kept").select("locator"), "dedup_kept")
    rows = docs.select(F.struct(*(docs[c].alias(c) for c in docs.columns)).alias("row"), locator())
    return rows.join(kept, "locator", "left_semi").select("row.*")
