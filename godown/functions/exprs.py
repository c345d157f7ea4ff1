"""Column expressions shared by the cleaning, Gold and dashboard layers.

All of them are built-in Spark SQL expressions, so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (results and labels must equal the reference's):
# movement classes and their quantile cuts, the dashboard pill classes,
# month abbreviations, the lakh unit, and the display formats.
FAST, MEDIUM, SLOW = "Fast-moving", "Medium-moving", "Slow-moving"
FAST_QUANTILE, SLOW_QUANTILE = 0.66, 0.33
PILL_CLASS = {"Fast-moving": "fast", "Medium-moving": "medium", "Slow-moving": "slow"}
MOVING_SUFFIX = "-moving"
LAKH = 1e5
DELAY_FORMAT, PCT_FORMAT, RATING_FORMAT = "%.2fd", "%.1f%%", "%.1f"
GROWTH_FORMAT, NO_GROWTH = "%+.1f%%", "N/A"
DOWN_CLASS, UP_CLASS = "danger", "good"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def first_row_flag(keys, order_sql) -> Column:
    """``row_number() OVER (PARTITION BY keys ORDER BY order_sql)``, built as one SQL expression.

    ``order_sql`` items are SQL sort items (``"`c` ASC NULLS FIRST"``).
    One expression string keeps the plan-building cost independent of the
    number of sort columns.
    """
    part = ", ".join(quote(k) for k in keys)
    return F.expr(f"row_number() OVER (PARTITION BY {part} ORDER BY {', '.join(order_sql)})")


def lenient_cast(c, to: str) -> Column:
    """Bad text becomes NULL instead of failing the job (ANSI mode)."""
    return col(c).try_cast(to)


def classify_movement(units, fast_cut, slow_cut) -> Column:
    """Three-way class; ``>= fast`` is tested before ``<= slow``."""
    u = col(units)
    return (F.when(u >= fast_cut, F.lit(FAST))
             .when(u <= slow_cut, F.lit(SLOW))
             .otherwise(F.lit(MEDIUM)))


def growth_pct(current, previous, scale: int = 2) -> Column:
    """(current - previous) / previous * 100; NULL when previous is NULL or 0."""
    cur, prev = col(current).cast("double"), col(previous).cast("double")
    return F.round(F.try_divide(cur - prev, prev) * 100, scale)


def lakh(c) -> Column:
    return F.round(col(c) / LAKH, 1)


def month_bucket(c) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def month_label(ym) -> Column:
    """'2026-05' -> 'May 2026'."""
    return F.date_format(F.to_date(col(ym), "yyyy-MM"), "MMM yyyy")


def first_word(c) -> Column:
    return F.substring_index(col(c), " ", 1)


def short_movement(c) -> Column:
    return F.replace(col(c), F.lit(MOVING_SUFFIX), F.lit(""))


def pill_class(c) -> Column:
    expr = F.lit("")
    for k, v in PILL_CLASS.items():
        expr = F.when(col(c) == k, F.lit(v)).otherwise(expr)
    return expr


def signed_pct_label(c) -> Column:
    """'+4.8%' / '-51.8%', 'N/A' for NULL."""
    return F.when(col(c).isNull(), F.lit(NO_GROWTH)).otherwise(F.format_string(GROWTH_FORMAT, col(c)))


def sign_class(c) -> Column:
    return (F.when(col(c).isNull(), F.lit(""))
             .when(col(c) < 0, F.lit(DOWN_CLASS)).otherwise(F.lit(UP_CLASS)))
