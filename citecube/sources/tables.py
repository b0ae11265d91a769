"""Persisting and registering the star schema.

* ``save_table``: every file sorted by the first column, overwritten,
  written by many tasks in parallel (no single writer).
* the fact table is written partitioned by ``time_id`` and range-clustered
  on ``author_id`` inside, so a year filter prunes folders (also through
  dynamic partition pruning from the time dimension) and an author filter
  skips row groups by their min/max statistics.
* ``register_star``: temp views over the written files (external tables).
* ``author_pub``: the distinct author-publication view over the bridge.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.lookup import join_right_distinct

STAR_TABLES = ("timeinfo", "venue_series", "title", "author", "document_type",
               "publication", "publication_author_map", "publication_citing_map")


def _ranged(df: DataFrame, n: int | None, *cols: str) -> DataFrame:
    # no explicit count: AQE sizes the output files from the data
    return df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)


def save_table(df: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """Each output file sorted by the first column.  Dimensions from
    ``dense_ids`` are already range-clustered by their id, so no extra
    shuffle is spent; ``num_partitions`` forces a range repartition."""
    first = df.columns[0]
    if num_partitions:
        df = df.repartitionByRange(num_partitions, first)
    df.sortWithinPartitions(first).write.mode("overwrite").option("compression", "zstd").parquet(path)


def save_fact(fact: DataFrame, path: str, num_partitions: int | None = None) -> None:
    # publication_id breaks ties: all rows of one range key go to one
    # partition, so without it a hot (year, author) would be one task/file.
    (_ranged(fact, num_partitions, "time_id", "author_id", "publication_id")
     .sortWithinPartitions("time_id", "author_id", "publication_id")
     .write.mode("overwrite").option("compression", "zstd").partitionBy("time_id").parquet(path))


def save_star(tables: dict[str, DataFrame], root: str, parallel: int = 4) -> None:
    """Write all tables; independent writes are submitted concurrently."""
    def save(item):
        name, df = item
        p = os.path.join(root, name)
        (save_fact if name == "publication" else save_table)(df, p)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(save, tables.items()))
    _write_manifest(tables, root)


MANIFEST = "tables.manifest"


def _write_manifest(tables: dict[str, DataFrame], root: str) -> None:
    """The names of the tables under ``root``, written last."""
    spark = next(iter(tables.values())).sparkSession
    (spark.createDataFrame([(n,) for n in tables], "value string").coalesce(1)
     .write.mode("overwrite").text(os.path.join(root, MANIFEST)))


SCHEMAS = {"timeinfo": S.TIMEINFO, "venue_series": S.VENUE_SERIES, "title": S.TITLE, "author": S.AUTHOR,
           "document_type": S.DOCUMENT_TYPE, "publication": S.PUBLICATION, "publication_author_map": S.BRIDGE,
           "publication_citing_map": S.CITING_BRIDGE}


def load_star(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read the written tables with their declared schemas (the fact's
    partition column keeps its LONG type instead of an inferred INT).
    ``fmt="escaped"`` reads escaped-CSV table folders (external text tables).
    Which tables there are stands in the manifest that the save wrote, so any
    store that Spark reads will do."""
    from . import csv_dialects
    present = {r["value"] for r in spark.read.text(os.path.join(root, MANIFEST)).collect()}

    def read(name):
        path = os.path.join(root, name)
        if fmt == "escaped":
            return csv_dialects.read_escaped(spark, path, SCHEMAS[name], strict=True)
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return {name: read(name) for name in STAR_TABLES if name in present}


def save_star_escaped(tables: dict[str, DataFrame], root: str) -> None:
    """Star tables as escaped-CSV folders (external text tables), each
    sorted by its first column."""
    from . import csv_dialects
    for name, df in tables.items():
        csv_dialects.write_escaped(df, os.path.join(root, name), order_by=df.columns[0])
    _write_manifest(tables, root)


def register_star(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "") -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
    author_pub(tables["author"], tables["publication_author_map"]).createOrReplaceTempView(
        prefix + "author_pub")


BUCKETED = ("publication", "author")
SALT = 4       # files of a bucket, so that a large author is not one task's work


def store_star(spark: SparkSession, tables: dict[str, DataFrame], root: str, prefix: str = "", buckets: int = 64) -> None:
    """External tables ``<prefix><name>`` over files below ``root``, with
    statistics.  The fact and the authors are bucketed by author: counting, summing
    or joining by author then needs no exchange."""
    for name, df in tables.items():
        if name in BUCKETED:
            bucket = F.pmod(F.hash("author_id"), F.lit(buckets))       # as Spark's bucketing has it
            writer = (df.repartition(buckets * SALT, bucket, F.pmod(F.xxhash64(*df.columns), F.lit(SALT)))
                      .write.bucketBy(buckets, "author_id").sortBy("author_id"))
        else:
            writer = df.write
        writer.format("parquet").mode("overwrite").option("path", os.path.join(root, name)).saveAsTable(prefix + name)
        spark.sql(f"ANALYZE TABLE `{prefix + name}` COMPUTE STATISTICS FOR ALL COLUMNS")


def author_pub(author: DataFrame, bridge: DataFrame) -> DataFrame:
    """DISTINCT (publication_id, author_id, name) of author RIGHT JOIN bridge;
    the author's own id column is kept (NULL when the id is unknown)."""
    return join_right_distinct(author, bridge, "author_id", ["publication_id", "author_id", "name"])
