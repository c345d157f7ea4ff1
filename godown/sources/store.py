"""Table sinks on plain parquet (1.9 - 1.14).

Without a transactional table format, a table that is rewritten from
itself (self-overwrite, SCD2 MERGE) is kept as numbered versions:

    <root>/v=<n>/        full table of version n, written by one Spark job
    <root>/_commits/     one row per committed version

A version becomes visible only after its data job succeeded and its
commit row was appended, so readers never see a half-written table and a
failed or repeated write leaves the previous version readable.  Reading
version n while writing n+1 is always legal.  Writes are by plain Spark
jobs, so the layout works on any file system Spark can write.

``publish`` makes the committed version visible as a catalog table
(``silver.suppliers_scd2``): an external parquet table whose location is
switched to the new version, so ``spark.table`` and SQL readers always see
one complete version (1.7, 1.12, 1.13).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from godown.sources.paths import if_exists

COMMITS = "version long, committed_at timestamp_ntz, counts map<string,bigint>"
MANIFEST = "version long, bucket int, held_by long, committed_at timestamp_ntz"
#: How tables are written: columns of like or rising values take less room in pages of version 2, and zstd less than the default.
FILES = {"compression": "zstd", "parquet.writer.version": "v2"}
#: Partition column of bucketed tables.
BUCKET = "_bucket"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def _commits(self) -> str:
        return f"{self.root}/_commits"

    def _log(self) -> DataFrame | None:
        """The commits, or None before the first one; an unreadable log raises."""
        return if_exists(lambda: self.spark.read.schema(COMMITS).parquet(self._commits))

    def current_version(self) -> int | None:
        """Highest committed version, or None if the table does not exist (1.13)."""
        log = self._log()
        return None if log is None else log.agg(F.max("version")).first()[0]

    def exists(self) -> bool:
        return self.current_version() is not None

    def has_version(self, version: int) -> bool:
        log = self._log()
        return log is not None and not log.where(F.col("version") == version).isEmpty()

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return self.spark.read.parquet(self.path(v))

    def counts(self, version: int | None = None) -> dict[str, int]:
        """What was counted while the version was written; always ``rows``."""
        v = self.current_version() if version is None else version
        row = None if v is None else self._log().where(F.col("version") == v).first()
        return {} if row is None else dict(row["counts"] or {})

    def write(self, df: DataFrame, version: int | None = None, partition_by: str | None = None,
              counts: dict[str, Column] | None = None) -> int:
        """1.9 / 1.11: write a new full version and commit it.

        Its rows, and aggregates named in ``counts``, are observed by the
        writing job itself (4.7, 1.14) and kept with the commit; nothing is
        read again for them.

        A folder that is already there is never replaced, with one
        exception: a caller that names its ``version`` (a stream batch that
        runs again) replaces what an earlier, uncommitted attempt left.
        """
        mode = "errorifexists"
        if version is None:
            cur = self.current_version()
            version = 1 if cur is None else cur + 1
        elif self.has_version(version):
            raise FileExistsError(f"version {version} of {self.root} is committed")
        else:
            mode = "overwrite"
        seen = Observation()
        named = {"rows": F.count(F.lit(1)), **(counts or {})}
        writer = df.observe(seen, *[c.alias(n) for n, c in named.items()]).write.mode(mode).options(**FILES)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(version))
        got = {n: int(v or 0) for n, v in seen.get.items()}
        commit = self.spark.createDataFrame(
            [(int(version), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), got)], COMMITS)
        commit.coalesce(1).write.mode("append").parquet(self._commits)
        return version


#: Place of a row in a table written by ``ordered``: the number of its sorted part and its place there.
PLACE = "_place"
PLACE_BITS = 33


def ordered(df: DataFrame, by) -> DataFrame:
    """The rows in the global order ``by`` (Columns), each with its place, ready to be written (9.1 - 9.3).

    Rows are dealt by ranges of the sort columns, so no task sorts or ranks
    the whole table; the place is fixed by the write.
    """
    return df.orderBy(*by).withColumn(PLACE, F.monotonically_increasing_id())


def ranked(written: DataFrame) -> DataFrame:
    """A written ``ordered`` table with ``rank`` from 1 in place of its places.

    The rank is the place in its part plus the sizes of the parts before:
    one row per part is summed up, and that table is broadcast.
    """
    part = F.shiftright(PLACE, PLACE_BITS)
    sizes = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.col(PLACE) - F.shiftleft(F.col("_part"), PLACE_BITS)
    out = written.withColumn("_part", part).join(F.broadcast(first), "_part")
    return out.withColumn("rank", F.col("_first") + within + 1).drop("_part", "_first", PLACE)


class BucketedTable:
    """A keyed table whose new versions rewrite only the buckets that changed.

    ::

        <root>/v=<n>/_bucket=<b>/   bucket b as of version n
        <root>/_manifest/           per committed version: every bucket and the version that holds it

    A key's bucket is a hash of the key.  Version n+1 writes the buckets
    that its batch touches and names the older folders for all others, so
    its cost follows the batch.  It is visible once its manifest rows are
    appended (one file); until then readers see version n, and a repeated
    write of n+1 replaces what the failed one left.  Folders are never
    changed after that, so readers of older versions are not disturbed.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def bucket_of(self, key) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def _log(self) -> DataFrame | None:
        return if_exists(lambda: self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_manifest"))

    def current_version(self) -> int | None:
        log = self._log()
        return None if log is None else log.agg(F.max("version")).first()[0]

    def exists(self) -> bool:
        return self.current_version() is not None

    def has_version(self, version: int) -> bool:
        log = self._log()
        return log is not None and not log.where(F.col("version") == version).isEmpty()

    def holders(self, version: int | None = None) -> dict[int, int]:
        """Bucket -> version whose folder holds it; at most ``buckets`` rows."""
        log = self._log()
        if log is None:
            return {}
        v = self.current_version() if version is None else version
        return {r["bucket"]: r["held_by"] for r in log.where((F.col("version") == v) & (F.col("bucket") >= 0)).collect()}

    def paths(self, buckets=None, version: int | None = None) -> list[str]:
        held = self.holders(version)
        return [f"{self.root}/v={v}/{BUCKET}={b}" for b, v in sorted(held.items()) if buckets is None or b in buckets]

    def read(self, schema: T.StructType, buckets=None, version: int | None = None) -> DataFrame:
        """The rows of all or some buckets."""
        paths = self.paths(buckets, version)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame, key, touched, version: int) -> int:
        """Commit ``version``: ``df`` is all there is in the buckets ``touched``."""
        if self.has_version(version):
            raise FileExistsError(f"version {version} of {self.root} is committed")
        held = self.holders()
        path = f"{self.root}/v={version}"
        # a bucket's rows meet in few files; AQE splits a large one
        (df.withColumn(BUCKET, self.bucket_of(key)).hint("rebalance", BUCKET)
         .write.mode("overwrite").options(**FILES).partitionBy(BUCKET).parquet(path))
        got = self.spark.read.schema(f"{BUCKET} int").parquet(path)
        filled = {r[0] for r in got.distinct().collect()}                     # at most `buckets`
        held = {b: v for b, v in held.items() if b not in touched} | {b: version for b in filled}
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = [(version, b, v, now) for b, v in sorted(held.items())] or [(version, -1, version, now)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/_manifest")
        return version


def append(df: DataFrame, path: str) -> None:
    """1.10: append-only sink (files are added, never rewritten)."""
    df.write.mode("append").options(**FILES).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """1.9: full refresh of a table that is not read by the same job."""
    df.write.mode("overwrite").parquet(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """1.14: (table_name, row_count) for a set of tables, one job.

    Each count is a partial + final aggregate; the union of the one-row
    results is collected by the caller, not by this function.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def create_schema(spark: SparkSession, name: str, location: str) -> None:
    """1.12: a layer schema (bronze / silver / gold), created only if missing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{location}'")


def table_exists(spark: SparkSession, name: str) -> bool:
    """1.13: first run (create) or later run (merge / switch)?"""
    return spark.catalog.tableExists(name)


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def publish_view(spark: SparkSession, name: str, paths: list[str], columns) -> None:
    """Point catalog view ``name`` at the parquet data of several folders (a bucketed table's current ones)."""
    cols = ", ".join(f"`{c}`" for c in columns)
    body = " UNION ALL ".join(f"SELECT {cols} FROM parquet.`{p}`" for p in paths)
    if not paths:
        raise ValueError(f"{name} has no data to publish")
    if table_exists(spark, name) and not is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")


def publish(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Point catalog table ``name`` at the parquet data in ``path``, with the columns of ``schema``.

    Same schema: the location is switched in one catalog update.  A new
    schema (additive evolution) re-creates the external table; the data
    files are never touched.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    if table_exists(spark, name) and is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
    if table_exists(spark, name):
        same = [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]
        if same:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.sql(f"REFRESH TABLE {name}")
            return
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
