"""Data-quality rules and quarantine (4.1 - 4.8).

A rule is a named SQL predicate.  A row passes only when every rule is
TRUE; a rule that evaluates to NULL counts as failed (D9), so
``passed + quarantined = input`` always holds.  Failed rows carry
``_dq_failed_rule``: the names of the failed rules, comma separated.

One pass tags every row; passed rows, quarantined rows and the counts are
all projections of that tagged frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.schemas import FEEDS

FAILED = "_dq_failed_rule"


def _pred(rule):
    return F.expr(rule) if isinstance(rule, str) else rule


def tag_rules(df: DataFrame, rules: dict) -> DataFrame:
    """4.1 / 4.2: add ``_dq_failed_rule`` (NULL when the row passes)."""
    names = [F.when(~F.coalesce(_pred(r), F.lit(False)), F.lit(n)) for n, r in rules.items()]
    failed = F.array_join(F.array_compact(F.array(*names)), ",")
    return df.withColumn(FAILED, F.when(failed != "", failed))


def passed_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(FAILED).isNull()).drop(FAILED)


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(FAILED).isNotNull())


def split(df: DataFrame, rules: dict) -> tuple[DataFrame, DataFrame]:
    tagged = tag_rules(df, rules)
    return passed_rows(tagged), quarantined_rows(tagged)


def rule_counts(df: DataFrame, rules: dict, table: str) -> DataFrame:
    """4.7: passed / quarantined counts of one table in one aggregate."""
    ok = F.lit(True)
    for r in rules.values():
        ok = ok & F.coalesce(_pred(r), F.lit(False))
    return df.agg(F.count_if(ok).alias("passed"), F.count_if(~ok).alias("quarantined")) \
             .select(F.lit(table).alias("table_name"), "passed", "quarantined")


def feed_rules(name: str) -> dict:
    """4.3 - 4.6: the rule set of a Silver feed."""
    return dict(FEEDS[name].rules)


def new_quarantine_rows(quarantine: DataFrame, existing: DataFrame | None, key) -> DataFrame:
    """4.8: rows not yet in the quarantine table, by (key, failed rules).

    Daily re-runs therefore do not pile up copies of the same failure.
    """
    if existing is None:
        return quarantine
    k = list(key) + [FAILED]
    seen = existing.select(*[F.col(c).alias(f"_q_{c}") for c in k]).distinct()
    same = F.lit(True)
    for c in k:
        same = same & F.col(c).eqNullSafe(F.col(f"_q_{c}"))       # a failure with a NULL key is known, too
    return quarantine.join(seen, same, "left_anti")
