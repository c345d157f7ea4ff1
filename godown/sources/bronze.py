"""Bronze ingestion: raw files + lineage, nothing cleaned (1.1, 1.3 - 1.6, 1.8).

* ``read_feed`` reads one feed from any number of files in one scan with a
  declared schema (every business column a string, so bad text survives
  to Silver), CSV columns matched by header name, and adds ``_source_file`` (base name of the file each row
  came from) and ``_ingest_timestamp`` (the run's stamp, one value for the
  whole run).
* ``infer_schema`` infers a schema once from a sample and stores it next
  to the checkpoint; later runs reload it (the reference's persisted
  schema location).
* ``read_evolving`` / ``union_evolving`` accept files whose column sets
  grew over time (additive evolution; missing columns read as NULL).
"""

from __future__ import annotations

import csv
import datetime as dt
import json
import re
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from godown.schemas import INGEST_TS, SOURCE_FILE, FeedSpec
from godown.sources.paths import if_exists


def lineage(df: DataFrame, ingest_ts: dt.datetime | None = None) -> DataFrame:
    """1.5: add the source file name and the ingestion timestamp."""
    ts = (F.lit(ingest_ts.isoformat(sep=" ")).cast("timestamp_ntz") if ingest_ts is not None
          else F.current_timestamp().cast("timestamp_ntz"))
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_name")).withColumn(INGEST_TS, ts)


#: Files whose first lines are fetched at the same time.
HEADER_READS = 16


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file on any file system that Spark reads, compressed or not; only its first block is fetched."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        content = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8")).readLine()
    finally:
        stream.close()


def headers(spark: SparkSession, paths, base: str | None = None) -> dict[str, tuple[str, ...]]:
    """The column names of each CSV file, from its first line; empty files have none.

    The lines are fetched beside Spark's file listing, a buffer per file:
    the data itself is read once, by the query.
    """
    reader = spark.read.option("basePath", base) if base else spark.read
    files = reader.text(paths).inputFiles()
    with ThreadPoolExecutor(max_workers=HEADER_READS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f), files))
    return {unquote(f): tuple(next(csv.reader([line.lstrip("\ufeff")]))) for f, line in zip(files, lines) if line}


def literal(path: str) -> str:
    """A path that Spark's readers take as it is, without pattern characters."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_csv_by_name(spark: SparkSession, paths, schema: T.StructType, base: str | None = None,
                     date_format: str | None = None, keep_new: bool = True) -> DataFrame:
    """CSV files whose columns are matched to ``schema`` by header name, file by file.

    Files with the same header are read together.  A column that a file
    lacks is NULL there; columns that ``schema`` doesn't know follow as text
    (``keep_new``; 1.4) instead of shifting the others.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in headers(spark, paths, base).items():
        groups.setdefault(names, []).append(file)
    known = {f.name: f for f in schema}
    out = None
    for names, files in sorted(groups.items()):
        reader = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
                  .schema(T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names])))
        if base:
            reader = reader.option("basePath", base)
        if date_format:
            reader = reader.option("dateFormat", date_format)
        df = lineage_file(reader.csv(sorted(map(literal, files))))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        return lineage_file(spark.read.schema(schema).csv(paths))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in out.columns]
    out = out.select("*", *missing)
    new = [c for c in out.columns if c not in known and c != SOURCE_FILE]
    return out.select(*known, *(new if keep_new else []), SOURCE_FILE)


def lineage_file(df: DataFrame) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_name"))


def read_feed(spark: SparkSession, spec: FeedSpec | None, paths, schema: T.StructType | None = None,
              ingest_ts: dt.datetime | None = None, fmt: str = "csv",
              date_format: str | None = None) -> DataFrame:
    """1.1 / 1.6 / 1.8: one feed from one or many files, lineage attached.

    Without ``schema`` every business column is read as text (Bronze keeps
    what arrived).  A typed ``schema`` with DATE columns and
    ``date_format`` parses dates while reading; unparseable values become
    NULL (PERMISSIVE mode).  CSV columns are matched by header name.
    """
    base = paths if isinstance(paths, str) else None
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = schema or spec.raw_schema()
    if fmt == "csv":
        ts = (F.lit(ingest_ts.isoformat(sep=" ")).cast("timestamp_ntz") if ingest_ts is not None
              else F.current_timestamp().cast("timestamp_ntz"))
        folder = base if base and not any(x in base for x in "*?[{") and not base.endswith(".csv") else None
        return read_csv_by_name(spark, paths, schema, folder, date_format).withColumn(INGEST_TS, ts)
    return lineage(spark.read.schema(schema).format(fmt).load(paths), ingest_ts)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none", options: dict | None = None) -> None:
    """Drop a DataFrame as a CSV feed (header line, one folder of part files)."""
    df.write.mode(mode).options(**(options or {})).option("header", True).option("compression", compression).csv(path)


def infer_schema(spark: SparkSession, paths, schema_dir: str, sampling_ratio: float = 1.0) -> T.StructType:
    """1.3: infer once, store as JSON under ``schema_dir``, reload afterwards.

    The stored copy is a one-line text dataset written by Spark, so it
    lives on whatever shared file system the checkpoint uses.
    """
    stored = if_exists(lambda: spark.read.text(schema_dir))
    if stored is not None:
        return T.StructType.fromJson(json.loads(stored.first()[0]))
    paths = [paths] if isinstance(paths, str) else list(paths)
    st = (spark.read.option("header", True).option("inferSchema", True)
          .option("samplingRatio", sampling_ratio).csv(paths).schema)
    spark.createDataFrame([(st.json(),)], "value string").coalesce(1).write.text(schema_dir)
    return st


def read_evolving(spark: SparkSession, paths, fmt: str = "parquet") -> DataFrame:
    """1.4: read files written with growing column sets; missing columns are NULL."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("mergeSchema", True).format(fmt).load(paths)


def union_evolving(*frames: DataFrame) -> DataFrame:
    """10.15 with additive schema: UNION ALL by name, missing columns NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
