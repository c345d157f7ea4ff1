"""The medallion layers of one data set as lazily composed DataFrames.

``Layers(spark, sf_dir)`` gives raw feeds, Silver tables, the supplier
history and the Gold tables as plans; nothing runs until an action.  It
replaces the reference's step runner: there are no intermediate files
between the layers unless a caller writes them (``godown.sources.store``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from godown.operators import clean, scd2
from godown.plans import gold
from godown.schemas import INGEST_TS, SOURCE_FILE, SUPPLIER_HISTORY_COLUMNS, SUPPLIER_TRACKED, SUPPLIERS
from godown.session import written
from godown.sources import feeds


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # raw feeds --------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return getattr(feeds, f"raw_{name}")(self.spark, self.sf_dir)

    # Silver -----------------------------------------------------------------
    @cached_property
    def products(self) -> DataFrame:
        return clean.clean_products(self.raw("products"))

    @cached_property
    def warehouse(self) -> DataFrame:
        return clean.clean_warehouse(self.raw("warehouse"))

    @cached_property
    def inventory(self) -> DataFrame:
        return clean.clean_inventory(self.raw("inventory"))

    @cached_property
    def orders(self) -> DataFrame:
        return clean.clean_orders(self.raw("orders"))

    @cached_property
    def sales(self) -> DataFrame:
        return clean.clean_sales(self.raw("sales"))

    @cached_property
    def supplier_snapshots(self) -> DataFrame:
        """Typed snapshots, re-ingested copies removed (D4)."""
        typed = clean.try_types(self.raw("supplier_snapshots"), SUPPLIERS.casts)
        return clean.dedupe_rows(typed)

    @cached_property
    def suppliers_scd2(self) -> DataFrame:
        snaps = self.supplier_snapshots.drop(SOURCE_FILE, INGEST_TS)
        return scd2.scd2_replay(snaps, "supplier_id", SUPPLIER_TRACKED, "source_date",
                                columns=SUPPLIER_HISTORY_COLUMNS)

    # Gold -------------------------------------------------------------------
    @cached_property
    def inventory_snapshot(self) -> DataFrame:
        return gold.inventory_snapshot(self.inventory, self.products, self.warehouse)

    @cached_property
    def low_stock_alerts(self) -> DataFrame:
        return gold.low_stock_alerts(self.inventory_snapshot)

    @cached_property
    def supplier_performance(self) -> DataFrame:
        return gold.supplier_performance(self.orders, self.suppliers_scd2)

    @cached_property
    def product_movement(self) -> DataFrame:
        return gold.product_movement(self.sales, self.products)

    @cached_property
    def sales_summary(self) -> DataFrame:
        return gold.sales_summary(self.sales, self.products, self.warehouse)

    @cached_property
    def sales_trends(self) -> DataFrame:
        return gold.sales_trends(self.sales)

    def movement_and_trends(self) -> tuple[DataFrame, DataFrame]:
        """G4 and G6 from one pass over the sales: deduplicated once, summed per product and month, written."""
        monthly = written(gold.sales_by_product_month(self.sales), "sales_by_product_month")
        return gold.product_movement(monthly, self.products), gold.sales_trends(monthly)

    def gold_tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in gold.ORDERING}


class BronzeLayers(Layers):
    """The same layers over landed Bronze tables (feed -> rows as text, with lineage)."""

    def __init__(self, spark: SparkSession, bronze: dict[str, DataFrame]):
        super().__init__(spark, "")
        self.bronze = bronze

    def raw(self, name: str) -> DataFrame:
        return self.bronze["suppliers" if name == "supplier_snapshots" else name]
