"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass 1 scatters whole records uniformly into memory-sized buckets by a seeded
hash.  Pass 2 Fisher-Yates shuffles each bucket (``shuffle`` on the bucket's
array) and writes it.  Buckets laid end to end are one random permutation of
the corpus, which is dealt to the shards in turn, so shard sizes differ by one
record at most."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, scratch_path

BUCKET_BYTES = 8 << 20     # target size of a bucket; one bucket is held in memory at a time
BUCKETS_PER_TASK = 1       # a task shuffles its buckets one after the other


def shuffle_shards(docs: DataFrame, shards: int = 8, seed: int = 17, bucket_bytes: int = BUCKET_BYTES,
                   id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write the shuffled records and return them as
    (record struct of all input columns, shard int, slot long).

    Law ``rows``: shard counts are at most one apart and slots run from 0
    without gaps.  The permutation depends on the seed, the ids and the texts.
    Null ids and null texts are records like any other; rows that repeat take
    a place each; an empty table gives no rows.  Extra columns travel inside
    ``record``, so no name can clash."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
                       F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("draw"))
    total = docs.select((F.coalesce(F.octet_length(text_col), F.lit(0)) + 64).alias("n")).agg(F.sum("n")).first()[0]
    buckets = max(1, -(-int(total or 0) // bucket_bytes))
    # Pass 1.  A second draw, independent of the hash, spreads rows that are alike in every column.
    salted = rows.withColumn("bucket", F.pmod(F.xxhash64("draw", F.monotonically_increasing_id()), F.lit(buckets)).cast("int"))
    scattered = salted.repartition(-(-buckets // BUCKETS_PER_TASK), "bucket")
    # Pass 2.  Sorting by the draw first makes the shuffle repeatable whatever order the rows arrive in.
    shuffled = (scattered.groupBy("bucket")
                .agg(F.array_sort(F.collect_list(F.struct("draw", "record"))).alias("rows"))
                .select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("place", "row"))
                .select("bucket", "place", "row.record"))
    path = path or scratch_path(spark, "shards")
    shuffled.write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    counts = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = materialize(counts.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("start")),
                         "shard-starts")
    place = F.col("start") + F.col("place")
    return (written.join(starts, "bucket")
            .select("record", F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
                    F.floor(place / shards).cast("long").alias("slot")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows as files of the original columns plus slot.
    ``shard`` and ``slot`` get underscores in front where the records have
    columns of these names."""
    taken = {f.name.lower() for f in sharded.schema["record"].dataType.fields}

    def free(name: str) -> str:
        return name if name not in taken else free("_" + name)

    shard = free("shard")
    (sharded.select("record.*", F.col("shard").alias(shard), F.col("slot").alias(free("slot")))
     .write.mode("overwrite").partitionBy(shard).parquet(path))
