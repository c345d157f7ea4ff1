"""CSV headers: names from first lines, without a job over the data."""

import gzip
import os

from pyspark.sql import functions as F

from godown.sources import bronze


def put(path, text, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt", encoding="utf-8") as f:
        f.write(text)


def test_headers_of_plain_compressed_and_empty_files(spark, tmp_dir):
    put(f"{tmp_dir}/in/a.csv", "id,name\n1,x\n")
    put(tmp_dir + "/in/b c%{1}[x].csv", "\ufeffname,id,\"more, yet\"\ny,2,z\n")
    put(f"{tmp_dir}/in/c.csv.gz", "id,name\n3,w\n", gzip.open)
    put(f"{tmp_dir}/in/d.csv", "")
    got = {os.path.basename(f): names for f, names in bronze.headers(spark, [f"{tmp_dir}/in"]).items()}
    assert got == {"a.csv": ("id", "name"), "b c%{1}[x].csv": ("name", "id", "more, yet"), "c.csv.gz": ("id", "name")}
    schema = "id string, name string"
    from pyspark.sql import types as T
    df = bronze.read_csv_by_name(spark, [f"{tmp_dir}/in"], T.StructType.fromDDL(schema))
    assert sorted((r.id, r.name, r["more, yet"]) for r in df.collect()) == [("1", "x", None), ("2", "y", "z"), ("3", "w", None)]


def test_headers_run_no_job_and_read_no_data(spark, tmp_dir):
    """One delivery of some megabytes: no Spark job for its headers, so the data is read once, by the query."""
    spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).write.option("header", True).csv(f"{tmp_dir}/in")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = bronze.headers(spark, [f"{tmp_dir}/in"])
        df = bronze.read_feed(spark, None, f"{tmp_dir}/in", schema=bronze.T.StructType.fromDDL("id string, h string"))
        assert list(tracker.getJobIdsForGroup("headers")) == []
        assert df.count() == 200_000 and len(tracker.getJobIdsForGroup("headers")) >= 1
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert set(found.values()) == {("id", "h")} and len(found) > 1
