"""Independent SQL statements of every registered query (DuckDB dialect).

They restate the feed derivations, the cleaning rules and the KPI logic
in plain SQL over the driver's tables, so that the Spark plans can be
checked against a second engine.  Dialect notes: ``percentile`` is
``quantile_cont``; Spark's ``round`` on doubles is HALF_UP on the shortest
decimal form, emulated by rounding a DECIMAL(38,10) cast; integer sums are
cast to BIGINT; money is summed as DECIMAL(18,2).
"""

from __future__ import annotations

TS_RUN = "TIMESTAMP '2026-07-02 06:00:00'"
TS_RESEND = "TIMESTAMP '2026-07-02 06:05:00'"
SNAP_DATES = ("1996-01-01", "1998-01-01", "2000-01-01")


def rnd(expr: str, n: int) -> str:
    """Spark's round() of a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def first_per(source: str, keys: list[str], order: list[str], cols: str = "* EXCLUDE (_rn)") -> str:
    """Rows of ``source`` that are first per key (ascending, NULLs first)."""
    o = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    k = ", ".join(keys)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS _rn "
            f"FROM {source}) WHERE _rn = 1")


def last_per(source: str, keys: list[str], order: list[str], cols: str = "* EXCLUDE (_rn)") -> str:
    o = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    k = ", ".join(keys)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS _rn "
            f"FROM {source}) WHERE _rn = 1")


LINEAGE_ORDER = ["_ingest_timestamp", "_source_file"]

# ---- raw feeds -------------------------------------------------------------
RAW = {}

RAW["raw_products"] = f"""
SELECT p_partkey AS product_id,
       CASE WHEN p_partkey % 50 = 11 THEN NULL ELSE p_name END AS product_name,
       p_type AS category,
       CASE WHEN p_partkey % 25 = 7 THEN NULL ELSE p_retailprice END AS unit_price,
       p_partkey % 10 AS supplier_id,
       'products.csv' AS _source_file, {TS_RUN} AS _ingest_timestamp
FROM part
UNION ALL
SELECT p_partkey, upper(p_name), p_type,
       CASE WHEN p_partkey % 25 = 7 THEN NULL ELSE p_retailprice END,
       p_partkey % 10, 'products_resend.csv', {TS_RESEND}
FROM part WHERE p_partkey % 25 = 3 OR p_partkey % 50 = 11
"""

RAW["raw_warehouse"] = f"""
SELECT n_nationkey AS warehouse_id, n_name AS warehouse_name, r_name AS location,
       CAST((n_regionkey + 1) * 10000 + n_nationkey * 100 AS INTEGER) AS capacity,
       'warehouse.csv' AS _source_file, {TS_RUN} AS _ingest_timestamp
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""

RAW["raw_sales"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS sale_id,
       l_partkey AS product_id,
       CAST(l_suppkey % 25 AS INTEGER) AS warehouse_id,
       CASE WHEN l_orderkey % 211 = 17 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS sale_date,
       CASE WHEN (l_orderkey + l_linenumber) % 53 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS quantity_sold,
       l_extendedprice / l_quantity AS unit_price,
       CASE WHEN (l_orderkey * 7 + l_linenumber) % 97 = 0 THEN -CAST(l_extendedprice AS DECIMAL(18,2))
            ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS revenue,
       'sales.csv' AS _source_file, {TS_RUN} AS _ingest_timestamp
FROM lineitem
"""

RAW["raw_orders"] = f"""
SELECT order_id, product_id, supplier_id, order_date, expected_delivery,
       CASE WHEN o_orderstatus = 'O' THEN NULL
            ELSE expected_delivery + CAST([-2, 0, 4, 0, 1, 0, 6][order_id_slot % 7 + 1] AS INTEGER) END
         AS actual_delivery,
       quantity_ordered, status, 'orders.csv' AS _source_file, {TS_RUN} AS _ingest_timestamp
FROM (
  SELECT l_orderkey * 10 + l_linenumber AS order_id, l_partkey AS product_id,
         CASE WHEN l_orderkey % 101 = 7 THEN -l_suppkey - 1 ELSE l_suppkey END AS supplier_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_orderdate AS DATE) + CAST(3 + l_partkey % 8 - CASE WHEN l_orderkey % 89 = 0 THEN 12 ELSE 0 END AS INTEGER)
           AS expected_delivery,
         l_orderkey + l_linenumber AS order_id_slot, o_orderstatus,
         CAST(l_quantity AS INTEGER) AS quantity_ordered,
         CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Partial' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

RAW["raw_inventory"] = f"""
SELECT product_id * 100 + warehouse_id AS inventory_id, product_id, warehouse_id,
       CAST(qty AS INTEGER) - CASE WHEN product_id % 97 = 13 THEN 1000 ELSE 0 END AS quantity_on_hand,
       CAST(20 + (product_id % 9) * 10 AS INTEGER) AS reorder_threshold,
       last_updated, 'inventory.csv' AS _source_file, {TS_RUN} AS _ingest_timestamp
FROM (SELECT l_partkey AS product_id, CAST(l_suppkey % 25 AS INTEGER) AS warehouse_id,
             sum(l_quantity) AS qty, max(CAST(l_shipdate AS DATE)) AS last_updated
      FROM lineitem GROUP BY 1, 2)
"""


def _snap(i: int, address: str, rating: str, where: str = "TRUE", source: str | None = None,
          ts: str = TS_RUN) -> str:
    d = SNAP_DATES[i]
    src = source or f"suppliers_{d}.csv"
    return f"""
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, {address} AS address,
       'supplier' || CAST(s_suppkey AS VARCHAR) || '@example.com' AS contact_email,
       CAST({rating} AS DOUBLE) AS rating, DATE '{d}' AS source_date,
       '{src}' AS _source_file, {ts} AS _ingest_timestamp
FROM sup_base WHERE {where}"""


_BASE_ADDR = "'addr-' || CAST(s_nationkey AS VARCHAR)"
_MOVED_ADDR = "'addr-' || CAST(s_nationkey + 100 AS VARCHAR)"
_BASE_RATING = "CAST(step AS DOUBLE) / CAST(10.0 AS DOUBLE) + CAST(1.0 AS DOUBLE)"
_NEW_RATING = "CAST((step + 7) % 41 AS DOUBLE) / CAST(10.0 AS DOUBLE) + CAST(1.0 AS DOUBLE)"

RAW["sup_base"] = """
SELECT *, CAST(floor(abs(s_acctbal)) AS BIGINT) % 41 AS step FROM supplier
"""
RAW["raw_supplier_snapshots"] = " UNION ALL ".join([
    _snap(0, _BASE_ADDR, _BASE_RATING, "s_suppkey % 5 <> 0"),
    _snap(0, _BASE_ADDR, _BASE_RATING, "s_suppkey % 5 <> 0 AND s_suppkey % 7 = 0",
          source="suppliers_resend.csv", ts=TS_RESEND),
    _snap(1, f"CASE WHEN s_suppkey % 5 = 1 THEN {_MOVED_ADDR} ELSE {_BASE_ADDR} END",
          f"CASE WHEN s_suppkey % 5 = 2 THEN {_NEW_RATING} ELSE {_BASE_RATING} END"),
    _snap(2, _BASE_ADDR,
          f"CASE WHEN s_suppkey % 5 = 3 THEN NULL WHEN s_suppkey % 5 = 2 THEN {_NEW_RATING} ELSE {_BASE_RATING} END"),
])

RAW["raw_customer_changes"] = """
SELECT o_custkey AS customer_id, o_orderpriority AS priority, o_orderstatus AS status,
       o_totalprice AS last_order_total, CAST(o_orderdate AS DATE) AS source_date, o_orderkey AS event_seq
FROM orders
"""

# ---- Silver ----------------------------------------------------------------
SILVER = {}

SILVER["p_typed"] = """
SELECT * FROM raw_products WHERE product_id IS NOT NULL AND product_name IS NOT NULL
"""
SILVER["p_dedup"] = first_per("p_typed", ["product_id"],
                              LINEAGE_ORDER + ["product_name", "category", "unit_price", "supplier_id"])
SILVER["s_products"] = """
SELECT product_id, product_name, category,
       coalesce(unit_price, (SELECT quantile_cont(unit_price, 0.5) FROM p_dedup)) AS unit_price, supplier_id
FROM p_dedup
"""
SILVER["s_products_catmed"] = """
SELECT d.product_id, d.product_name, d.category, coalesce(d.unit_price, m.med) AS unit_price, d.supplier_id
FROM p_dedup d LEFT JOIN (SELECT category, quantile_cont(unit_price, 0.5) AS med FROM p_dedup GROUP BY category) m
  ON d.category IS NOT DISTINCT FROM m.category
"""
SILVER["s_warehouse"] = first_per("raw_warehouse", ["warehouse_id"],
                                  LINEAGE_ORDER + ["warehouse_name", "location", "capacity"])
SILVER["inv_typed"] = """
SELECT inventory_id, product_id, warehouse_id, coalesce(quantity_on_hand, 0) AS quantity_on_hand,
       coalesce(reorder_threshold, 0) AS reorder_threshold, last_updated, _source_file, _ingest_timestamp
FROM raw_inventory WHERE product_id IS NOT NULL AND warehouse_id IS NOT NULL
"""
SILVER["s_inventory"] = first_per("inv_typed", ["inventory_id"],
                                  LINEAGE_ORDER + ["product_id", "warehouse_id", "quantity_on_hand",
                                                   "reorder_threshold", "last_updated"])
SILVER["ord_typed"] = """
SELECT order_id, product_id, supplier_id, order_date, expected_delivery, actual_delivery,
       coalesce(quantity_ordered, 0) AS quantity_ordered, status, _source_file, _ingest_timestamp
FROM raw_orders WHERE order_id IS NOT NULL AND supplier_id IS NOT NULL AND product_id IS NOT NULL
"""
SILVER["ord_dedup"] = first_per("ord_typed", ["order_id"],
                                LINEAGE_ORDER + ["product_id", "supplier_id", "order_date", "expected_delivery",
                                                 "actual_delivery", "quantity_ordered", "status"])
SILVER["s_orders"] = """
SELECT *, CAST(date_diff('day', expected_delivery, actual_delivery) AS INTEGER) AS delay_days FROM ord_dedup
"""
SILVER["sal_typed"] = """
SELECT sale_id, product_id, warehouse_id, sale_date, coalesce(quantity_sold, 0) AS quantity_sold,
       unit_price, CAST(revenue AS DOUBLE) AS revenue, _source_file, _ingest_timestamp
FROM raw_sales WHERE sale_id IS NOT NULL AND product_id IS NOT NULL AND warehouse_id IS NOT NULL
  AND coalesce(quantity_sold, 0) > 0
"""
SILVER["s_sales"] = first_per("sal_typed", ["sale_id"],
                              LINEAGE_ORDER + ["product_id", "warehouse_id", "sale_date", "quantity_sold",
                                               "unit_price", "revenue"])
SILVER["sup_rows"] = first_per("raw_supplier_snapshots",
                               ["supplier_id", "supplier_name", "address", "contact_email", "rating", "source_date"],
                               LINEAGE_ORDER)
SILVER["sup_day"] = last_per("sup_rows", ["supplier_id", "source_date"],
                             ["supplier_name", "address", "contact_email", "rating", "_source_file",
                              "_ingest_timestamp"])
SILVER["s_suppliers_scd2"] = """
SELECT supplier_id, supplier_name, address, contact_email, rating,
       source_date AS effective_start,
       lead(source_date) OVER (PARTITION BY supplier_id ORDER BY source_date) AS effective_end,
       lead(source_date) OVER (PARTITION BY supplier_id ORDER BY source_date) IS NULL AS is_current
FROM (SELECT *,
             lag(source_date) OVER w IS NULL
             OR address IS DISTINCT FROM lag(address) OVER w
             OR rating IS DISTINCT FROM lag(rating) OVER w AS _new
      FROM sup_day WHERE source_date IS NOT NULL
      WINDOW w AS (PARTITION BY supplier_id ORDER BY source_date))
WHERE _new
"""

CTES = {**RAW, **SILVER}


def with_ctes(body: str, extra: dict | None = None) -> str:
    """Prefix ``body`` with every CTE it needs (transitively)."""
    pool = {**CTES, **(extra or {})}
    names = list(pool)
    needed: list[str] = []

    def visit(text: str):
        for n in names:
            if n in needed:
                continue
            if _mentions(text, n):
                visit(pool[n])
                if n not in needed:
                    needed.append(n)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({pool[n]})" for n in needed) + "\n" + body


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(rf"(?<![A-Za-z0-9_]){re.escape(name)}(?![A-Za-z0-9_])", text) is not None
