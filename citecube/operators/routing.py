"""Two-way routing of rows (good / rejected) as plain filters on one input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_not_null(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(rows where ``col`` is set, rows where it is NULL)."""
    return df.filter(F.col(col).isNotNull()), df.filter(F.col(col).isNull())


def route_errors(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add ``route`` = name of the first failing check, or ``ok``.  The
    caller splits with two filters; the checks run once per row."""
    route = F.lit("ok")
    for name, failed in reversed(list(checks.items())):
        route = F.when(failed, F.lit(name)).otherwise(route)
    return df.withColumn("route", route)
