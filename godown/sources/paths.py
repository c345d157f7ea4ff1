"""Reading what may not be there yet, without mistaking a damaged table for a missing one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame


def if_exists(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None if its path does not exist; every other error is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
