"""Raw feeds derived from the driver's TPC-H-like tables.

The supply-chain pipeline expects six raw feeds (products, warehouse,
inventory, purchase orders, sales, supplier snapshots).  These functions
derive them lazily from ``part``, ``nation``/``region``, ``lineitem``,
``orders`` and ``supplier`` so that every query's work grows with the
tables.  The derivations are column arithmetic on each row, plus one
join (lineitem -> orders, for purchase-order dates), one aggregate
(inventory per product and warehouse slot) and a tiny nation -> region
lookup.  The defects the cleaning layer has to handle are injected by
fixed rules on the keys:

* products: NULL price, re-sent rows, a NULL name fixed by a re-send (D12)
* sales / orders: duplicate business keys (lineitem's own), NULL
  quantities, NULL dates, refunds (negative revenue), open orders without
  a delivery date, expected-before-order dates
* suppliers: three snapshots with address changes, a revert, a rating
  change, a NULL rating and a re-ingested file; some purchase orders
  name a supplier id that is not in the supplier master (orphans)

The SQL oracle in ``godown.oracle`` restates every rule independently.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from godown.schemas import INGEST_TS, SOURCE_FILE

# Fixed values of the derived feeds (shared with the SQL oracle).
RUN_TS = dt.datetime(2026, 7, 2, 6, 0, 0)          # pipeline run stamp of the raw drop
RESEND_TS = dt.datetime(2026, 7, 2, 6, 5, 0)       # the later re-sent product file
SNAPSHOT_DATES = (dt.date(1996, 1, 1), dt.date(1998, 1, 1), dt.date(2000, 1, 1))
N_WAREHOUSES = 25                                  # warehouse = nation key of the supplier slot
DELAY_CHOICES = (-2, 0, 4, 0, 1, 0, 6)             # delivery delay in days, picked by line slot


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_literal(ts: dt.datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{ts.isoformat(sep=' ')}'")


def _lineage(df: DataFrame, source_file: str, ts: dt.datetime = RUN_TS) -> DataFrame:
    return df.withColumns({SOURCE_FILE: F.lit(source_file), INGEST_TS: ts_literal(ts)})


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")

    def rows(name_col: Column) -> DataFrame:
        return part.select(
            k.alias("product_id"),
            name_col.alias("product_name"),
            F.col("p_type").alias("category"),
            F.when(k % 25 == 7, F.lit(None).cast("double")).otherwise(F.col("p_retailprice")).alias("unit_price"),
            (k % 10).alias("supplier_id"),
        )

    first = _lineage(rows(F.when(k % 50 == 11, F.lit(None).cast("string")).otherwise(F.col("p_name"))),
                     "products.csv")
    resend = _lineage(rows(F.upper("p_name")).where((k % 25 == 3) | (k % 50 == 11)),
                      "products_resend.csv", RESEND_TS)
    return first.unionByName(resend)


def raw_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    df = (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
          .select(F.col("n_nationkey").alias("warehouse_id"),
                  F.col("n_name").alias("warehouse_name"),
                  F.col("r_name").alias("location"),
                  ((F.col("n_regionkey") + 1) * 10000 + F.col("n_nationkey") * 100).cast("int").alias("capacity")))
    return _lineage(df, "warehouse.csv")


def _line_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    slot = F.col("l_orderkey") + F.col("l_linenumber")
    money = F.col("l_extendedprice").cast("decimal(18,2)")
    df = li.select(
        _line_id().alias("sale_id"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_suppkey") % N_WAREHOUSES).cast("int").alias("warehouse_id"),
        F.when(F.col("l_orderkey") % 211 == 17, F.lit(None).cast("date"))
         .otherwise(F.to_date("l_shipdate")).alias("sale_date"),
        F.when(slot % 53 == 0, F.lit(None).cast("int"))
         .otherwise(F.col("l_quantity").cast("int")).alias("quantity_sold"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.when((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 97 == 0, -money)
         .otherwise(money).alias("revenue"),
    )
    return _lineage(df, "sales.csv")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase orders: one per line, dated by the parent order."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    slot = (F.col("l_orderkey") + F.col("l_linenumber")) % len(DELAY_CHOICES)
    delay = F.element_at(F.array(*[F.lit(d) for d in DELAY_CHOICES]), (slot + 1).cast("int"))
    lead = (F.lit(3) + F.col("l_partkey") % 8
            - F.when(F.col("l_orderkey") % 89 == 0, F.lit(12)).otherwise(F.lit(0))).cast("int")
    order_date = F.to_date("o_orderdate")
    expected = F.date_add(order_date, lead)
    df = (li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
          .select(
              _line_id().alias("order_id"),
              F.col("l_partkey").alias("product_id"),
              F.when(F.col("l_orderkey") % 101 == 7, -F.col("l_suppkey") - 1)
               .otherwise(F.col("l_suppkey")).alias("supplier_id"),
              order_date.alias("order_date"),
              expected.alias("expected_delivery"),
              F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("date"))
               .otherwise(F.date_add(expected, delay)).alias("actual_delivery"),
              F.col("l_quantity").cast("int").alias("quantity_ordered"),
              F.when(F.col("o_orderstatus") == "F", "Delivered")
               .when(F.col("o_orderstatus") == "O", "Open").otherwise("Partial").alias("status"),
          ))
    return _lineage(df, "orders.csv")


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock per (product, warehouse) slot seen in the line data.

    Only pairs that occur are built (no product x warehouse cartesian).  The
    aggregate is keyed by ``inventory_id`` itself, so its output is already
    hash-partitioned the way the Silver dedupe by ``inventory_id`` needs.
    """
    li = table(spark, sf_dir, "lineitem")
    inv_id = F.col("l_partkey") * 100 + (F.col("l_suppkey") % N_WAREHOUSES)
    agg = (li.groupBy(inv_id.alias("inventory_id"))
           .agg(F.sum("l_quantity").alias("qty"), F.max(F.to_date("l_shipdate")).alias("last_updated")))
    p = F.floor(F.col("inventory_id") / 100).cast("bigint")
    df = agg.select(
        "inventory_id",
        p.alias("product_id"),
        (F.col("inventory_id") % 100).cast("int").alias("warehouse_id"),
        (F.col("qty").cast("int") - F.when(p % 97 == 13, F.lit(1000)).otherwise(F.lit(0))).alias("quantity_on_hand"),
        (F.lit(20) + (p % 9) * 10).cast("int").alias("reorder_threshold"),
        "last_updated",
    )
    return _lineage(df, "inventory.csv")


def raw_supplier_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three supplier snapshot files plus one re-ingested copy of the first."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    step = (F.floor(F.abs(F.col("s_acctbal"))).cast("bigint") % 41)
    base_addr = F.concat(F.lit("addr-"), F.col("s_nationkey").cast("string"))
    moved_addr = F.concat(F.lit("addr-"), (F.col("s_nationkey") + 100).cast("string"))
    base_rating = step / 10.0 + 1.0
    new_rating = ((step + 7) % 41) / 10.0 + 1.0

    def snap(i: int, address: Column, rating: Column) -> DataFrame:
        d = SNAPSHOT_DATES[i]
        return _lineage(s.select(
            k.alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            address.alias("address"),
            F.concat(F.lit("supplier"), k.cast("string"), F.lit("@example.com")).alias("contact_email"),
            rating.cast("double").alias("rating"),
            F.lit(d).alias("source_date"),
        ), f"suppliers_{d.isoformat()}.csv")

    s1 = snap(0, base_addr, base_rating).where(k % 5 != 0)
    s1_again = s1.where(k % 7 == 0).withColumn(SOURCE_FILE, F.lit("suppliers_resend.csv")) \
                 .withColumn(INGEST_TS, ts_literal(RESEND_TS))
    s2 = snap(1, F.when(k % 5 == 1, moved_addr).otherwise(base_addr),
              F.when(k % 5 == 2, new_rating).otherwise(base_rating))
    s3 = snap(2, base_addr,
              F.when(k % 5 == 3, F.lit(None).cast("double"))
               .when(k % 5 == 2, new_rating).otherwise(base_rating))
    return s1.unionByName(s1_again).unionByName(s2).unionByName(s3)


def raw_customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as a change feed of customer attributes (large SCD2 input)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("last_order_total"),
        F.to_date("o_orderdate").alias("source_date"),
        F.col("o_orderkey").alias("event_seq"),
    )
