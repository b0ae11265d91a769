"""Distinct / unique-rows operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_rows(df: DataFrame, keys: list[str], order_cols: list[str],
                case_insensitive: tuple[str, ...] = ()) -> DataFrame:
    """One row per key list, comparing the listed keys case-insensitively;
    the kept row is the first by ``order_cols``.  ``min`` over a struct led
    by the order columns is partially aggregated map-side, so a hot key
    collapses before the shuffle and no group is ever collected."""
    norm = [F.lower(F.col(k)).alias(f"_u_{k}") if k in case_insensitive else F.col(k).alias(f"_u_{k}")
            for k in keys]
    cols = list(df.columns)
    rest = [c for c in cols if c not in order_cols]
    picked = (df.select(*norm, F.struct(*[F.col(c) for c in order_cols + rest]).alias("_u_row"))
              .groupBy(*[f"_u_{k}" for k in keys])
              .agg(F.min("_u_row").alias("_u_row")))
    return picked.select("_u_row.*").select(*cols)


def union_distinct(frames: list[DataFrame], col: str) -> DataFrame:
    """Union all of one column from several frames, then distinct."""
    out = frames[0].select(col)
    for f in frames[1:]:
        out = out.unionByName(f.select(col))
    return out.distinct()
