"""Surrogate keys (dense, deterministic, computed without a single-task
window).

``dense_ids`` numbers rows 1..N in the order of a total sort key:

1. range-partition on the sort key and sort inside each partition;
2. tag every row with its partition and its position in that partition;
3. write a snapshot into the shared ``spark.checkpoint.dir`` folder (parquet)
   - this fixes the range boundaries and positions, cuts lineage and
   survives executor loss;
4. count rows per partition (one row per partition, collected - bounded by
   the partition count, not by the data), turn the counts into running
   offsets, a literal in the plan, and add ``offset + position``.  The result
   is a plain scan of the snapshot: joins with it are planned from its real
   size (a join with a table of offsets was estimated at the product of both).

The id equals ``row_number() OVER (ORDER BY keys)`` when the keys are unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

_PART, _MONO, _CNT = "_ck_part", "_ck_mono", "_ck_cnt"


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str,
              num_partitions: int | None = None, first_id: int = 1) -> DataFrame:
    """Append ``id_col`` = rank of the row by ``order_cols`` (1-based).

    ``order_cols`` must identify a row (add a unique tie-break column)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # Without an explicit count AQE sizes the range partitions from the data
    # (a 7-row dimension ends up in one partition, a large one stays spread);
    # coalescing keeps neighbouring ranges together, so order is preserved.
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *order_cols)
    else:
        ranged = df.repartitionByRange(*order_cols)
    ranged = (ranged
              .sortWithinPartitions(*order_cols)
              .withColumn(_PART, F.spark_partition_id())
              .withColumn(_MONO, F.monotonically_increasing_id()))
    # Lazy reliable checkpoint: the per-partition count below is the job that
    # computes the sorted partitions, and they are written right after it
    # from the same shuffle output (fixed range bounds, unique sort keys),
    # so counts and checkpointed positions agree.
    # Snapshot to the shared folder: fixes range bounds and positions,
    # cuts lineage, survives executor loss.
    ranged = materialize(ranged, "dense-ids")
    # One row per range partition: a bounded collect, whatever the data size.
    counts = dict(ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias(_CNT)).collect())
    offsets, run = [], 0
    for p in range(max(counts, default=0) + 1):
        offsets.append(run)
        run += counts.get(p, 0)
    offset = F.get(F.lit(offsets).cast("array<long>"), F.col(_PART))
    position = F.col(_MONO) - F.shiftleft(F.col(_PART).cast("long"), 33)
    return (ranged.withColumn(id_col, (offset + position + F.lit(first_id)).cast("long"))
            .drop(_PART, _MONO))
