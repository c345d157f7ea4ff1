"""What several operators share: table access, written intermediates, hashing of words."""

from __future__ import annotations

import gc
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from godown.session import scratch_path

#: Arrow batches are worked on in slices of about this many bytes of text.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Let go of shuffle files whose data frames are no longer in use (Spark drops them with the garbage)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Spark drops the shuffle files of a job when it ends.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Folders that ``written`` has made inside ``passing``; None outside.
_PASSING: ContextVar[list | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession):
    """Tables that ``written`` makes inside are deleted at the end, but for those taken out of the list that this gives."""
    paths: list[str] = []
    before = _PASSING.set(paths)
    try:
        yield paths
    finally:
        _PASSING.reset(before)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    ``free``: the write's shuffle files go when it ends, not when the garbage
    collector comes by; for large shuffles that nothing else uses.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    spark, schema = df.sparkSession, df.schema
    if (paths := _PASSING.get()) is not None:
        paths.append(path)
    before = spark.conf.get(FILE_CLEANUP, None)
    if free:
        spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)
    release(spark)
    return spark.read.schema(schema).parquet(path)


def crc_mod(col, n: int):
    """crc32 of the id as text, modulo n (the train / held-out split)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def slices(batches, text_col: str = "text", size: int = SLICE_BYTES):
    """Cut Arrow batches into pieces of about ``size`` bytes of text (at least one row)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text_col))
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
        part = np.cumsum(sizes) // size
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def out_batch(names, arrays):
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names=names)
