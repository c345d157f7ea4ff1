"""Silver cleaning operators: lenient typing, dedupe, imputation, per-feed cleaners.

Every function is ``DataFrame -> DataFrame`` and lazy: medians are scalar
subqueries, not driver round trips, so each cleaner stays one plan.

Order inside a cleaner (decision D12): cast, drop rows missing required
columns or failing the row filter, *then* dedupe by business key, then
impute.  The reference deduped first and could lose a key whose first row
was bad although a later row was good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.functions.exprs import first_row_flag, lenient_cast, quote
from godown.operators.quantiles import group_quantiles, quantile_values
from godown.schemas import (INGEST_TS, INVENTORY, LINEAGE, ORDERS, PRODUCTS, SALES, SOURCE_FILE,
                            WAREHOUSE, FeedSpec)


#: Column of texts that did not parse, as JSON by column name.
RESCUED = "_rescued"


def rescued(df: DataFrame, casts: dict):
    """The texts of columns that their cast can't read, as JSON; NULL if there are none (blank text is a missing value)."""
    kinds = dict(df.dtypes)
    lost = [F.when(F.expr(f"try_cast({quote(c)} AS {t})").isNull() & (F.trim(c) != ""), F.col(c)).alias(c)
            for c, t in casts.items() if kinds.get(c) == "string"]
    if not lost:
        return F.lit(None).cast("string")
    text = F.to_json(F.struct(*lost))
    return F.when(text != "{}", text)


def rescued_rows(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """Every Bronze row of a feed with text that can't be read as its type: business key as text, the texts, lineage.

    Silver has NULL, zero or no row for these; here they can be looked up
    and mended, whatever the cleaning steps did with the row.
    """
    lineage = [c for c in LINEAGE if c in raw.columns]
    keys = [F.col(c).cast("string").alias(c) for c in spec.key if c not in spec.casts]
    return raw.select(*keys, rescued(raw, spec.casts).alias(RESCUED), *lineage).where(F.col(RESCUED).isNotNull())


def try_types(df: DataFrame, casts: dict, zero_fill=(), rescue: bool = False) -> DataFrame:
    """Lenient casts (3.1, 3.2) and NULL -> 0 for listed quantities (3.4).

    ``try_cast`` returns NULL for text that does not parse, where a plain
    cast would fail the job under ANSI mode.  ``rescue`` keeps such text in
    the column RESCUED.
    """
    if rescue:
        df = df.withColumn(RESCUED, rescued(df, casts))
    out = []
    for c in df.columns:
        e = quote(c)
        if c in casts:
            e = f"try_cast({e} AS {casts[c]})"
        if c in zero_fill:
            e = f"coalesce({e}, CAST(0 AS {casts.get(c, 'int')}))"
        out.append(e if e == quote(c) else f"{e} AS {quote(c)}")
    return df.selectExpr(*out)


def drop_incomplete(df: DataFrame, required) -> DataFrame:
    """Drop rows with a NULL in any required column (2.2)."""
    cols = [c for c in required if c in df.columns]
    if not cols:
        return df
    return df.dropna(how="any", subset=cols)


def default_order(df: DataFrame, keys) -> list[str]:
    """Tie-break for 'first row wins': lineage first, then every other column.

    Rows that tie on all of these are identical, so the result is
    deterministic whatever the physical order of the input.
    """
    lineage = [c for c in (INGEST_TS, SOURCE_FILE) if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in lineage]
    return lineage + rest


def dedupe(df: DataFrame, keys, order_by=None) -> DataFrame:
    """Keep the first row per business key (3.5).

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before
    the shuffle, so a hot key is cut to one row per map task before it
    reaches a reducer.
    """
    keys = list(keys)
    order = list(order_by) if order_by is not None else default_order(df, keys)
    rn = first_row_flag(keys, [f"{quote(c)} ASC NULLS FIRST" for c in order])
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def dedupe_rows(df: DataFrame, ignore=LINEAGE) -> DataFrame:
    """Full-row dedupe on business columns only (3.6, D4).

    Re-ingested files differ only in lineage; they must not make new rows.
    The earliest lineage of each distinct row is kept.
    """
    business = [c for c in df.columns if c not in ignore]
    lineage = [c for c in (INGEST_TS, SOURCE_FILE) if c in df.columns]
    if not lineage:
        return df.dropDuplicates(business)
    return dedupe(df, business, lineage)


def impute_median(df: DataFrame, c: str, by: str | None = None, approx: bool = False) -> DataFrame:
    """Fill NULLs of ``c`` with the median (3.7), or the median per group (3.8).

    Exact and with bounded memory, from a written table of values and counts,
    or with ``approx=True`` a sketch value with relative rank error 0.01 (7.8,
    7.9).  Global: a constant.  Per group: one row per group, joined back.
    """
    method = "approx" if approx else "exact"
    kind = df.schema[c].dataType
    if by is None:
        return df.withColumn(c, F.coalesce(F.col(c), quantile_values(df, c, [0.5], method)[0].cast(kind)))
    med = group_quantiles(df, c, 0.5, by, method).select(F.col("g").alias("_g"), F.col("q").alias("_median"))
    out = df.join(med, F.col(by).eqNullSafe(F.col("_g")), "left")
    return out.withColumn(c, F.coalesce(F.col(c), F.col("_median").cast(kind))).select(*df.columns)


def clean_feed(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Generic Silver cleaner driven by a feed spec."""
    df = try_types(df, spec.casts, spec.zero_fill)
    df = drop_incomplete(df, spec.required)
    if spec.row_filter:
        df = df.where(spec.row_filter)
    df = dedupe(df, spec.key)
    if not spec.keep_lineage:
        df = df.drop(*[c for c in LINEAGE if c in df.columns])
    if spec.silver_columns:
        df = df.select(*spec.silver_columns)
    return df


# ---- per-feed cleaners (3.10 - 3.14) ---------------------------------------

def clean_products(raw: DataFrame, category_median: bool = False, approx: bool = False) -> DataFrame:
    df = clean_feed(raw, PRODUCTS)
    return impute_median(df, "unit_price", by="category" if category_median else None, approx=approx)


def clean_warehouse(raw: DataFrame) -> DataFrame:
    return clean_feed(raw, WAREHOUSE)


def clean_inventory(raw: DataFrame) -> DataFrame:
    return clean_feed(raw, INVENTORY)


def clean_orders(raw: DataFrame) -> DataFrame:
    df = clean_feed(raw, ORDERS)
    return df.withColumn("delay_days", F.datediff("actual_delivery", "expected_delivery"))


def clean_sales(raw: DataFrame) -> DataFrame:
    return clean_feed(raw, SALES)


CLEANERS = {
    "products": clean_products,
    "warehouse": clean_warehouse,
    "inventory": clean_inventory,
    "orders": clean_orders,
    "sales": clean_sales,
}


def step_counts(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """Row counts before/after each cleaning step in one job (1.15).

    Returns (feed, rows_in, zero_filled, after_required, after_filter,
    rows_out); ``zero_filled`` counts rows whose missing or unreadable
    quantity was replaced by 0 (D10).
    """
    missing = F.lit(False)
    for c in spec.zero_fill:
        missing = missing | lenient_cast(c, spec.casts.get(c, "int")).isNull()
    df = try_types(raw.withColumn("_zero_filled", missing), spec.casts, spec.zero_fill)
    req = F.lit(True)
    for c in spec.required:
        req = req & F.col(c).isNotNull()
    flt = F.coalesce(F.expr(spec.row_filter), F.lit(False)) if spec.row_filter else F.lit(True)
    key = F.struct(*spec.key)   # a struct is never NULL, so a NULL key still counts once
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("_zero_filled")).alias("zero_filled"),
        F.count_if(req).alias("after_required"),
        F.count_if(req & flt).alias("after_filter"),
        F.count_distinct(F.when(req & flt, key)).alias("rows_out"),
    ).select(F.lit(spec.name).alias("feed"), "*")
