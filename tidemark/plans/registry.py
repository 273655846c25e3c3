"""Reports by name, each with the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Report = Callable[[SparkSession, str], DataFrame]

REPORTS: dict[str, Report] = {}
SQL: dict[str, str] = {}


def report(sql: str | None):
    """Register a report under its function name."""

    def add(function: Report) -> Report:
        REPORTS[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def load_all() -> tuple[dict[str, Report], dict[str, str]]:
    from tidemark.plans import (  # noqa: F401
        app_store,
        basic,
        deliveries,
        pairs,
        rolling,
        states,
        streams,
        triggers,
        usage,
        windows,
    )

    return REPORTS, SQL
