"""Structured Streaming ingestion (1.2, 11.1 - 11.4).

``stream_feed`` is incremental file ingestion: every file in the input
folder is read exactly once (the checkpoint records which), the run stops
when it has caught up (``availableNow``), and a re-run only picks up files
that arrived since.  ``stream_scd2`` feeds the supplier dimension from the
same kind of stream: each micro-batch is merged by ``foreachBatch`` into a
history whose versions rewrite only the buckets of the batch's keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from godown.operators import clean, quality, scd2
from godown.schemas import INGEST_TS, SOURCE_FILE
from godown.session import in_parallel
from godown.sources.bronze import infer_schema, lineage, read_feed
from godown.sources.paths import if_exists
from godown.sources.store import BUCKET, FILES, BucketedTable

#: Partition column of landed batches.
BATCH = "_batch"


#: Files are never too old to be read: the source would skip those a week older than the newest one.
ANY_AGE = "36500d"
FILE_ROW = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, in_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the files of a folder, each once; their contents are not read by it."""
    reader = spark.readStream.format("binaryFile").schema(FILE_ROW).option("maxFileAge", ANY_AGE).option("pathGlobFilter", "[!_.]*")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(in_dir).select("path")


def read_files(spark: SparkSession, schema: T.StructType, files: list[str], fmt: str) -> DataFrame:
    """The rows of one delivery with lineage; columns by name, new ones kept (1.4)."""
    if fmt == "csv":
        return read_feed(spark, None, files, schema=schema)
    df = spark.read.option("mergeSchema", True).format(fmt).load(files)
    df = df if SOURCE_FILE in df.columns else lineage(df)         # landed rows have theirs
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in df.columns])


def read_landed(spark: SparkSession, out_dir: str) -> DataFrame:
    """What ``stream_feed`` has landed: all batches, columns that came later NULL in earlier ones."""
    return spark.read.option("mergeSchema", True).parquet(out_dir).drop(BATCH)


def stream_feed(spark: SparkSession, schema: T.StructType | None, in_dir: str, out_dir: str, checkpoint: str,
                fmt: str = "csv", max_files_per_trigger: int | None = 1000) -> int:
    """1.2 / 11.1 / 11.2: ingest everything available, then stop.

    ``schema=None`` infers the schema once from the files present and
    stores it next to the checkpoint (1.3); later runs reuse the stored
    schema.  ``max_files_per_trigger`` bounds each micro-batch, so a large
    backlog is worked off in several checkpointed batches.  A batch lands in
    a folder of its own that a repeated batch replaces, so each file lands
    exactly once.  Returns the number of rows that this run landed.
    """
    if schema is None:
        schema = infer_schema(spark, in_dir, checkpoint.rstrip("/") + "_schema")
    landed = []

    def land(batch: DataFrame, batch_id: int) -> None:
        files = [r["path"] for r in batch.collect()]              # at most max_files_per_trigger
        if files:
            path = f"{out_dir}/{BATCH}={batch_id}"
            read_files(spark, schema, files, fmt).write.mode("overwrite").options(**FILES).parquet(path)
            landed.append(spark.read.parquet(path).count())

    q = (new_files(spark, in_dir, max_files_per_trigger).writeStream.foreachBatch(land)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return sum(landed)


def stream_feeds(spark: SparkSession, feeds: dict, root: str, workers: int = 4) -> dict[str, int]:
    """11.3: one stream per feed, the same function for each, ``workers`` at a time.

    ``feeds``: name -> (schema, input folder).  Output and checkpoint of a
    feed live under ``root/<name>`` and ``root/_checkpoints/<name>``.
    """
    def run(name: str) -> int:
        schema, in_dir = feeds[name]
        return stream_feed(spark, schema, in_dir, f"{root}/{name}", f"{root}/_checkpoints/{name}")

    return in_parallel(run, feeds, workers)


#: Bucket of rows that no history can take.
SET_ASIDE = -1


class History:
    """A type-2 history that snapshot deliveries maintain, bucketed by key.

    ::

        <root>/history/                          BucketedTable of versions (with scd2.LAST_SEEN)
        <root>/snapshots/_batch=<i>/_bucket=<b>/ the typed snapshots of delivery i
        <root>/snapshots/_batch=<i>/_bucket=-1/  its rows without a readable date: the quarantine (3.3)
    """

    def __init__(self, spark: SparkSession, root: str, key, tracked, at: str, casts: dict, columns, tie=(), buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        self.attrs = [c for c in columns if c not in self.key]
        self.tracked, self.at, self.casts, self.tie = list(tracked), at, casts, list(tie)
        self.store = BucketedTable(spark, f"{self.root}/history", buckets)

    def versions(self, buckets=None) -> DataFrame | None:
        """All stored columns of the history, or of some buckets; None before the first delivery with a dated row."""
        held = self.store.paths()
        return self.store.read(self.spark.read.parquet(held[0]).schema, buckets) if held else None

    def read(self) -> DataFrame:
        """The history without bookkeeping."""
        got = self.versions()
        if got is None:
            raise FileNotFoundError(f"no delivery has been merged under {self.root}")
        return got.drop(scd2.LAST_SEEN)

    def snapshots(self) -> DataFrame | None:
        return if_exists(lambda: self.spark.read.parquet(f"{self.root}/snapshots"))

    def quarantine(self) -> DataFrame | None:
        """Rows set aside by committed deliveries, each distinct one once, with the rule and the unreadable text; None before the first."""
        rows, done = self.snapshots(), self.store.current_version()
        if rows is None or done is None:
            return None
        bad = rows.where((F.col(BUCKET) == SET_ASIDE) & (F.col(BATCH) < done)).drop(BATCH, BUCKET, self.at)
        return clean.dedupe_rows(bad)

    def merge(self, delivery: DataFrame, batch_id: int) -> None:
        """Store the delivery's snapshots, rewrite the buckets of its keys, commit as version batch_id + 1.

        The delivery is evaluated once.  Every step replaces what an earlier
        attempt has left, so a repeated delivery changes nothing.
        """
        version = batch_id + 1
        if self.store.has_version(version):
            return
        typed = clean.dedupe_rows(clean.try_types(delivery, self.casts, rescue=True))
        tagged = quality.tag_rules(typed, scd2.snapshot_rules(self.at))
        bucket = F.when(F.col(quality.FAILED).isNull(), self.store.bucket_of(self.key)).otherwise(SET_ASIDE)
        path = f"{self.root}/snapshots/{BATCH}={batch_id}"
        stored = tagged.withColumn(BUCKET, bucket)
        stored.hint("rebalance", BUCKET).write.mode("overwrite").options(**FILES).partitionBy(BUCKET).parquet(path)
        rows = self.spark.read.schema(stored.schema).parquet(path).where(F.col(BUCKET) != SET_ASIDE)
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]       # at most `buckets`
        held = self.store.holders()
        if any(b in held for b in touched):
            known = self.versions(touched)
            earlier = self.snapshots().where((F.col(BATCH) < batch_id) & F.col(BUCKET).isin(touched))
        else:
            day = F.lit(None).cast(rows.schema[self.at].dataType)
            earlier = rows.limit(0)
            known = earlier.select(*self.key, *self.attrs, day.alias(scd2.START), day.alias(scd2.END),
                                   F.lit(True).alias(scd2.CURRENT), day.alias(scd2.LAST_SEEN))
        merged = scd2.merge_snapshots(known, rows, earlier, self.key, self.tracked, self.at, self.tie)
        self.store.write(merged, self.key, touched, version)


def stream_scd2(spark: SparkSession, schema: T.StructType, in_dir: str, root: str, checkpoint: str,
                key, tracked, at: str, casts: dict, columns, tie=(), buckets: int = 64, fmt: str = "csv",
                max_files_per_trigger: int = 1000) -> History:
    """11.4: on every new snapshot file, merge it into the stored history.

    A micro-batch becomes version ``batch_id + 1``; one that runs again after
    a failure does nothing if that is committed, else it starts over.  It
    reads and rewrites the buckets of its keys only (``store.BucketedTable``),
    and earlier snapshots only of those buckets.  Rows whose date can't be
    read go to the history's quarantine (3.3).
    """
    history = History(spark, root, key, tracked, at, casts, columns, tie, buckets)

    def merge_batch(files: DataFrame, batch_id: int) -> None:
        names = [r["path"] for r in files.collect()]              # at most max_files_per_trigger
        if names:
            history.merge(read_files(spark, schema, names, fmt), batch_id)

    q = (new_files(spark, in_dir, max_files_per_trigger).writeStream
         .foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return history
