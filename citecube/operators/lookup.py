"""Dimension lookups and the join shapes of the transform jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import join_side, materialize


def dim_lookup(left: DataFrame, left_key: str, dim: DataFrame, dim_key: str, dim_id: str,
               out_col: str, missing: int = -1, unique: bool = False) -> DataFrame:
    """Left lookup: every left row once, with the first (smallest) id of the
    matching dimension rows, or ``missing``.  Never multiplies rows.
    ``unique=True`` states that ``dim_key`` is already distinct (dimensions
    built by distinct), which saves the de-duplicating aggregation; otherwise
    its result is written first.  So both join inputs are plain scans, and AQE
    picks the join from their sizes and splits a key that many rows share;
    ``join_side`` keeps a large one from being broadcast."""
    if unique:
        firsts = dim.select(F.col(dim_key).alias("_lk_key"), F.col(dim_id).alias("_lk_id"))
    else:
        firsts = dim.groupBy(F.col(dim_key).alias("_lk_key")).agg(F.min(dim_id).alias("_lk_id"))
        firsts = materialize(firsts, "lookup")
    firsts = join_side(firsts)
    joined = left.join(firsts, left[left_key] == firsts["_lk_key"], "left")
    return joined.withColumn(out_col, F.coalesce(F.col("_lk_id"), F.lit(missing)).cast("long")) \
                 .drop("_lk_key", "_lk_id")


def count_matches(left: DataFrame, left_key: str, left_id: str,
                  right: DataFrame, right_key: str, out_col: str) -> DataFrame:
    """Per left key: (first left id, number of right rows with that key).

    Keys only on the right are dropped; keys without a match count 0; left
    rows sharing a key collapse to the first id.  The right side is
    aggregated before the join, so a hot key collapses map-side."""
    firsts = left.groupBy(F.col(left_key).alias("_cm_key")).agg(F.min(left_id).alias(left_id))
    counts = right.groupBy(F.col(right_key).alias("_cm_key")).agg(F.count(F.lit(1)).alias("_cm_n"))
    return (firsts.join(counts, "_cm_key", "left")
            .select(left_id, F.coalesce(F.col("_cm_n"), F.lit(0)).cast("long").alias(out_col)))


def merge_column(fact: DataFrame, fact_id: str, mapping: DataFrame, map_id: str,
                 map_value: str, target: str) -> DataFrame:
    """Inner merge into the fact: sets ``target`` from the mapping and emits
    one fact row per mapping row (rows without a mapping disappear)."""
    m = mapping.select(F.col(map_id).alias("_mg_id"), F.col(map_value).alias("_mg_val"))
    return (fact.join(m, fact[fact_id] == m["_mg_id"], "inner")
            .withColumn(target, F.col("_mg_val")).drop("_mg_id", "_mg_val"))


def join_left(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left")


def join_inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "inner")


def join_full(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "full")


def join_right_distinct(dim: DataFrame, bridge: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """``SELECT DISTINCT cols FROM dim RIGHT JOIN bridge USING key``; the
    dimension's own key column is kept, so a miss shows NULL."""
    d = dim.withColumnRenamed(key, "_rj_key")
    j = d.join(bridge, d["_rj_key"] == bridge[key], "right")
    return j.select(*[F.col("_rj_key").alias(key) if c == key else F.col(c) for c in cols]).distinct()


def join_three_way(a: DataFrame, b: DataFrame, c: DataFrame, key: str) -> DataFrame:
    """Two chained inner joins on one key: all three sides shuffle on the
    same key once, the second join reuses the partitioning."""
    return a.join(b, key, "inner").join(c, key, "inner")
