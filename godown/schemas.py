"""Feed specifications: declared columns, keys, casts, rules.

Specs are data, so one cleaner, one ingester and one rule checker serve all
feeds.  Raw CSV files are read with every business column as a string
(``raw_schema``); the Silver cleaners turn them into typed columns with
lenient casts.  Feeds that already arrive typed (parquet) pass through the
same casts unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Lineage columns added by Bronze ingestion.
SOURCE_FILE = "_source_file"
INGEST_TS = "_ingest_timestamp"
LINEAGE = (SOURCE_FILE, INGEST_TS)


@dataclass(frozen=True)
class FeedSpec:
    name: str
    columns: tuple[str, ...]             # business columns, in file order
    key: tuple[str, ...]                 # business key for dedupe
    casts: dict = field(default_factory=dict)       # column -> Spark SQL type, lenient
    zero_fill: tuple[str, ...] = ()      # NULL after cast -> 0 (D10)
    required: tuple[str, ...] = ()       # rows with NULL here are dropped
    row_filter: str | None = None        # extra Silver predicate (NULL drops the row)
    keep_lineage: bool = True            # Silver keeps _source_file/_ingest_timestamp
    silver_columns: tuple[str, ...] | None = None   # projection of Silver, None = all
    rules: dict = field(default_factory=dict)       # DQ rule name -> SQL predicate

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])


PRODUCTS = FeedSpec(
    name="products",
    columns=("product_id", "product_name", "category", "unit_price", "supplier_id"),
    key=("product_id",),
    casts={"unit_price": "double"},
    required=("product_id", "product_name"),
    keep_lineage=False,
    silver_columns=("product_id", "product_name", "category", "unit_price", "supplier_id"),
    rules={"unit_price_positive": "unit_price > 0"},
)

WAREHOUSE = FeedSpec(
    name="warehouse",
    columns=("warehouse_id", "warehouse_name", "location", "capacity"),
    key=("warehouse_id",),
    casts={"capacity": "int"},
)

INVENTORY = FeedSpec(
    name="inventory",
    columns=("inventory_id", "product_id", "warehouse_id", "quantity_on_hand",
             "reorder_threshold", "last_updated"),
    key=("inventory_id",),
    casts={"quantity_on_hand": "int", "reorder_threshold": "int", "last_updated": "date"},
    zero_fill=("quantity_on_hand", "reorder_threshold"),
    required=("product_id", "warehouse_id"),
    rules={"quantity_on_hand_non_negative": "quantity_on_hand >= 0",
           "reorder_threshold_non_negative": "reorder_threshold >= 0"},
)

ORDERS = FeedSpec(
    name="orders",
    columns=("order_id", "product_id", "supplier_id", "order_date", "expected_delivery",
             "actual_delivery", "quantity_ordered", "status"),
    key=("order_id",),
    casts={"order_date": "date", "expected_delivery": "date", "actual_delivery": "date",
           "quantity_ordered": "int"},
    zero_fill=("quantity_ordered",),
    required=("order_id", "supplier_id", "product_id"),
    rules={"expected_after_order": "expected_delivery >= order_date"},
)

SALES = FeedSpec(
    name="sales",
    columns=("sale_id", "product_id", "warehouse_id", "sale_date", "quantity_sold",
             "unit_price", "revenue"),
    key=("sale_id",),
    casts={"sale_date": "date", "quantity_sold": "int", "unit_price": "double",
           "revenue": "double"},
    zero_fill=("quantity_sold",),
    required=("sale_id", "product_id", "warehouse_id"),
    row_filter="quantity_sold > 0",
    rules={"quantity_sold_positive": "quantity_sold > 0",
           "revenue_non_negative": "revenue >= 0"},
)

SUPPLIERS = FeedSpec(
    name="suppliers",
    columns=("supplier_id", "supplier_name", "address", "contact_email", "rating",
             "source_date"),
    key=("supplier_id", "source_date"),
    casts={"rating": "double", "source_date": "date"},
)

# Type-2 history settings of the supplier dimension.
SUPPLIER_TRACKED = ("address", "rating")
SUPPLIER_HISTORY_COLUMNS = ("supplier_id", "supplier_name", "address", "contact_email", "rating")

FEEDS = {s.name: s for s in (PRODUCTS, WAREHOUSE, INVENTORY, ORDERS, SALES, SUPPLIERS)}
