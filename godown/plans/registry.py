"""Registered queries: a Spark plan and (where SQL can say it) a SQL twin.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's tables
in ``sf_dir``.  ``ORACLE[name]`` is the same result in DuckDB SQL, built
from ``godown.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all():
    # importing the modules registers their queries
    from godown.plans import q_clean, q_dashboard, q_gold, q_quality, q_scd2, q_sources  # noqa: F401
    return QUERIES, ORACLE
