"""Materialise the layers: the scheduled job (replaces the reference's step runner).

Silver tables are written first and Gold is computed from the *written*
Silver tables, so each layer is one job per table and the plans do not
carry the lineage of earlier layers (an executor lost while building Gold
re-reads Silver files instead of recomputing raw feeds).

With ``quality=True`` the rule-checked Silver tables keep only passing
rows (the failing ones stay in the same write, in another partition) and
the failures are appended to ``<table>_quarantine`` - once per (key,
rule), so daily re-runs do not pile up copies (D9).  Everything is
written under ``root``: a folder on the cluster's shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from godown.operators import clean, quality, scd2
from godown.plans import gold
from godown.plans.pipeline import BronzeLayers, Layers
from godown.schemas import FEEDS, SUPPLIER_HISTORY_COLUMNS, SUPPLIER_TRACKED, SUPPLIERS
from godown.session import JOB_CONF, SORTED_SCANS, in_parallel, settings
from godown.sources import store
from godown.sources.paths import if_exists
from godown.streaming import ingest

SILVER = ("products", "warehouse", "inventory", "orders", "sales", "suppliers_scd2")
CHECKED = ("inventory", "sales", "orders", "products")
PASSED = "_dq_passed"
#: What tells two undated snapshots apart.
_SNAPSHOT_KEY = (*SUPPLIER_HISTORY_COLUMNS, clean.RESCUED)


class SilverTable:
    """A written Silver table; rule-checked ones hold passed and failed rows.

    A checked table is written once, partitioned by ``_dq_passed``: Silver
    readers see the ``true`` partition (partition pruning reads nothing
    else), the quarantine takes the ``false`` one.  No row is written twice.
    """

    def __init__(self, table: store.VersionedTable, checked: bool, schema: T.StructType):
        self.spark = table.spark
        self.table = table
        self.checked = checked
        self.schema = schema

    def current_version(self) -> int | None:
        return self.table.current_version()

    def _rows(self) -> DataFrame:
        # the schema is given: a checked table without rows has no files to infer it from
        return self.spark.read.schema(self.schema).parquet(self.table.path(self.table.current_version()))

    def read(self) -> DataFrame:
        df = self._rows()
        if self.checked:
            df = df.where(F.col(PASSED).cast("string") == "true").drop(PASSED, quality.FAILED)
        return df

    def rows(self) -> int:
        """Rows that ``read`` gives, as counted by the writing job."""
        counts = self.table.counts()
        return counts["passed"] if self.checked else counts["rows"]

    def failed(self) -> DataFrame:
        return self._rows().where(F.col(PASSED).cast("string") == "false").drop(PASSED)

    def publish(self, name: str) -> None:
        """Silver readers in the catalog see the rows and columns that ``read`` gives: passing rows, no tags."""
        v = self.table.path(self.table.current_version())
        path = f"{v}/{PASSED}=true" if self.checked else v
        store.publish(self.spark, name, path, self.read().schema)


class SilverHistory:
    """The supplier history that deliveries maintain, as a Silver table."""

    def __init__(self, history: ingest.History):
        self.history = history

    def current_version(self) -> int | None:
        return self.history.store.current_version()

    def read(self) -> DataFrame:
        return self.history.read()

    def rows(self) -> int:
        return self.history.read().count()                # from the footers of its files

    def publish(self, name: str) -> None:
        store.publish_view(self.history.spark, name, self.history.store.paths(), self.read().columns)


def _quarantine_path(root: str, name: str) -> str:
    return f"{root}/silver/{name}_quarantine"


def _write_one_silver(spark: SparkSession, layers: Layers, root: str, name: str, checked: bool) -> SilverTable:
    df = getattr(layers, name)
    table = store.VersionedTable(spark, f"{root}/silver/{name}")
    if not checked:
        table.write(df)
        return SilverTable(table, False, df.schema)
    tagged = quality.tag_rules(df, FEEDS[name].rules).withColumn(PASSED, F.col(quality.FAILED).isNull())
    table.write(tagged, partition_by=PASSED,
                counts={"passed": F.count_if(F.col(PASSED)), "quarantined": F.count_if(~F.col(PASSED))})
    silver = SilverTable(table, True, tagged.schema)
    _quarantine(spark, root, name, silver.failed(), FEEDS[name].key)
    return silver


def _quarantine(spark: SparkSession, root: str, name: str, failed: DataFrame, key) -> None:
    """4.8: append the failures that are not in ``<name>_quarantine`` yet."""
    path = _quarantine_path(root, name)
    existing = if_exists(lambda: spark.read.schema(failed.schema).parquet(path))
    store.append(quality.new_quarantine_rows(failed, existing, key), path)


def quarantine_snapshots(spark: SparkSession, layers: Layers, root: str) -> None:
    """3.3: snapshots without a readable date, which no history can take."""
    rows = clean.dedupe_rows(clean.try_types(layers.raw("supplier_snapshots"), SUPPLIERS.casts, rescue=True))
    bad = scd2.split_snapshots(rows, "supplier_id", "source_date")[1]
    _quarantine(spark, root, "suppliers", bad.drop("source_date"), _SNAPSHOT_KEY)


def merge_suppliers(spark: SparkSession, root: str) -> SilverHistory:
    """11.4 in the job: the deliveries that Bronze has taken since the last run, merged into the supplier history."""
    history = ingest.stream_scd2(
        spark, SUPPLIERS.raw_schema(), f"{root}/bronze/suppliers/*", f"{root}/silver/suppliers_scd2",
        f"{root}/_checkpoints/suppliers_scd2", "supplier_id", SUPPLIER_TRACKED, "source_date", SUPPLIERS.casts,
        SUPPLIER_HISTORY_COLUMNS, fmt="parquet")
    bad = history.quarantine()
    if bad is not None:
        _quarantine(spark, root, "suppliers", bad, _SNAPSHOT_KEY)
    return SilverHistory(history)


def write_silver(spark: SparkSession, layers: Layers, root: str, quality_checks: bool = True,
                 workers: int = 4, deliveries: bool = False) -> dict:
    """Every Silver table; with ``deliveries`` the supplier history is merged from Bronze instead of replayed.

    Text from deliveries that can't be read as its type is kept in
    ``<feed>_rescued`` (3.1, 3.2).
    """
    def write(name: str):
        if deliveries:
            feed = "suppliers" if name == "suppliers_scd2" else name
            raw = layers.raw("supplier_snapshots" if feed == "suppliers" else feed)
            store.VersionedTable(spark, f"{root}/silver/{feed}_rescued").write(clean.rescued_rows(raw, FEEDS[feed]))
        if name == "suppliers_scd2" and deliveries:
            return merge_suppliers(spark, root)
        if name == "suppliers_scd2" and quality_checks:
            quarantine_snapshots(spark, layers, root)
        return _write_one_silver(spark, layers, root, name, quality_checks and name in CHECKED)

    return in_parallel(write, SILVER, workers)


def write_bronze(spark: SparkSession, feed_dirs: dict[str, str], root: str) -> dict[str, DataFrame]:
    """11.3: one stream per feed, run until it has caught up; what has landed so far."""
    ingest.stream_feeds(spark, {n: (FEEDS[n].raw_schema(), d) for n, d in feed_dirs.items()}, f"{root}/bronze")
    return {n: ingest.read_landed(spark, f"{root}/bronze/{n}") for n in feed_dirs}


def write_gold(spark: SparkSession, silver: dict, root: str, workers: int = 4) -> dict:
    s = {n: t.read() for n, t in silver.items()}
    snapshot = gold.inventory_snapshot(s["inventory"], s["products"], s["warehouse"])
    tables = {
        "inventory_snapshot": snapshot,
        "supplier_performance": gold.supplier_performance(s["orders"], s["suppliers_scd2"]),
        "product_movement": gold.product_movement(s["sales"], s["products"]),
        "sales_summary": gold.sales_summary(s["sales"], s["products"], s["warehouse"]),
        "sales_trends": gold.sales_trends(s["sales"]),
    }
    def write(name: str) -> store.VersionedTable:
        t = store.VersionedTable(spark, f"{root}/gold/{name}")
        t.write(store.ordered(tables[name], gold.order_of(name)))
        return t

    def write_with_alerts(name: str) -> list[tuple[str, store.VersionedTable]]:
        done = [(name, write(name))]
        if name == "inventory_snapshot":              # the alerts are rows of the written snapshot: its joins run once
            tables["low_stock_alerts"] = gold.low_stock_alerts(done[0][1].read().drop(store.PLACE))
            done.append(("low_stock_alerts", write("low_stock_alerts")))
        return done

    return dict(sum(in_parallel(write_with_alerts, list(tables), workers).values(), []))


def publish_layer(spark: SparkSession, schema: str, tables: dict, root: str) -> None:
    """Expose the committed versions as ``<schema>.<table>`` in the catalog."""
    store.create_schema(spark, schema, f"{root}/_schemas/{schema}")
    for name, t in tables.items():
        if isinstance(t, (SilverTable, SilverHistory)):
            t.publish(f"{schema}.{name}")
        else:
            store.publish(spark, f"{schema}.{name}", t.path(t.current_version()), t.read().schema)


def run_pipeline(spark: SparkSession, sf_dir: str | None, root: str, quality_checks: bool = True,
                 workers: int = 4, feed_dirs: dict[str, str] | None = None) -> DataFrame:
    """Raw feeds -> Silver -> Gold on disk; returns the row-count audit (1.14), counted by the writing jobs.

    ``feed_dirs`` (feed -> folder or glob of its CSV deliveries) makes it the
    full job: every feed is first streamed into Bronze under ``root``, each
    file once over all runs, and Silver is read from Bronze.  Without it the
    feeds are derived from the tables in ``sf_dir``.

    The written versions are also published as ``silver.*`` and ``gold.*``
    catalog tables.  The tables of one layer are independent jobs and are
    submitted ``workers`` at a time, so small tables do not leave the
    cluster idle while one large table finishes.
    """
    with settings(spark, JOB_CONF):
        with settings(spark, SORTED_SCANS):
            layers = Layers(spark, sf_dir) if feed_dirs is None else BronzeLayers(spark, write_bronze(spark, feed_dirs, root))
            silver = write_silver(spark, layers, root, quality_checks, workers, deliveries=feed_dirs is not None)
        publish_layer(spark, "silver", silver, root)
        gold_tables = write_gold(spark, silver, root, workers)
        publish_layer(spark, "gold", gold_tables, root)
        counts = [(f"silver.{n}", t.rows()) for n, t in silver.items()]
        counts += [(f"gold.{n}", t.counts()["rows"]) for n, t in gold_tables.items()]
        return spark.createDataFrame(counts, "table_name string, row_count long")
