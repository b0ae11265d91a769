"""Incremental import: new XML record files -> staged rows -> a star whose ids stay.

A Structured Streaming query picks up files that arrived since the last run;
``trigger(availableNow=True)`` processes everything new and stops - a scheduled
refresh; the checkpoint location remembers what was read.  Every micro-batch runs
the batch import on its files (records never span files), numbers the records
after those of earlier batches, and registers new years, types and author names
(``KeyRegistry``).  All outputs of a batch are folders named by its number, which
a replay replaces: each file counts once, and an id never changes.

``stable_star`` builds the star from what is staged, with the registered ids as
dimensions; equal to a batch build up to the naming of ids."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.text import decade, split_list
from ..operators.registry import KeyRegistry
from ..plans.star import StarSchema, build_star
from ..sources import adapter
from ..sources.xml_chunks import number_by_place, place_chunks
from ..sources.xml_records import COL_COLUMNS, KEY_SEP, PUB_COLUMNS, counted_rows, rejects_of

PUBLICATIONS, COLLECTIONS, REJECTS = "publications", "collections", "rejects"


def registries(spark: SparkSession, target_dir: str) -> dict[str, KeyRegistry]:
    def make(name: str, key: str, kind: T.DataType, id_col: str) -> KeyRegistry:
        return KeyRegistry(spark, os.path.join(target_dir, "keys", name), T.StructType([T.StructField(key, kind)]), id_col)
    return {"author": make("author", "author", T.StringType(), "author_id"),
            "year": make("year", "year", T.LongType(), "time_id"),
            "type": make("type", "type", T.StringType(), "type_id")}


def _staged(spark: SparkSession, target_dir: str, name: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema, T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).parquet(os.path.join(target_dir, name))


def _prepare(spark: SparkSession, target_dir: str) -> None:
    """An empty batch -1 of each table, so that there is something to read."""
    for name, schema in ((PUBLICATIONS, S.STAGED_PUBLICATIONS), (COLLECTIONS, S.STAGED_COLLECTIONS)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(os.path.join(target_dir, name, "batch=-1"))


def import_batch(raw: DataFrame, batch: int, target_dir: str) -> dict[str, int]:
    """One batch of (file, block, chunk) rows into the staged tables and the
    registries; returns the counts of records."""
    spark = raw.sparkSession
    rows, seen = counted_rows(place_chunks(raw))
    keys = registries(spark, target_dir)
    pubs = rows.where("kind = 'publication'")

    def stage(name: str, kind: str, columns: list[str], schema: T.StructType) -> None:
        last = _staged(spark, target_dir, name, schema).where(F.col("batch") < batch).agg(F.max("id")).first()[0] or 0
        numbered = number_by_place(rows.where(F.col("kind") == kind))
        (numbered.select((F.col("seq") + last).alias("id"), *columns)
         .write.mode("overwrite").parquet(os.path.join(target_dir, name, f"batch={batch}")))

    # Outputs of the written rows that do not depend on each other: side by side, as most are small.
    steps = [lambda: stage(PUBLICATIONS, "publication", PUB_COLUMNS, S.STAGED_PUBLICATIONS),
             lambda: stage(COLLECTIONS, "collection", COL_COLUMNS, S.STAGED_COLLECTIONS),
             lambda: rejects_of(rows).write.mode("overwrite").parquet(os.path.join(target_dir, REJECTS, f"batch={batch}")),
             lambda: keys["author"].assign(pubs.select(F.explode(split_list("authors")).alias("author")), batch),
             lambda: keys["year"].assign(pubs, batch),
             lambda: keys["type"].assign(rows.where("kind != 'reject'"), batch)]
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()
    return seen


def start_dblp_import(spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str,
                      max_files_per_trigger: int = 64, available_now: bool = True):
    _prepare(spark, target_dir)
    raw = (spark.readStream.format("text").option("lineSep", KEY_SEP)
           .option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir)
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.col("value").alias("chunk")))
    writer = (raw.writeStream.foreachBatch(lambda df, batch: import_batch(df, batch, target_dir) and None)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_dblp_import(spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str,
                    max_files_per_trigger: int = 64) -> None:
    """Process all files that are new since the last run, then return."""
    q = start_dblp_import(spark, source_dir, target_dir, checkpoint_dir, max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def staged_tables(spark: SparkSession, target_dir: str) -> tuple[DataFrame, DataFrame]:
    """(publications, collections) of all batches so far, with their ids."""
    return (_staged(spark, target_dir, PUBLICATIONS, S.STAGED_PUBLICATIONS).drop("batch"),
            _staged(spark, target_dir, COLLECTIONS, S.STAGED_COLLECTIONS).drop("batch"))


def stable_star(spark: SparkSession, target_dir: str) -> StarSchema:
    """The star of everything staged so far, with ids that later batches keep:
    records by their place, years, types and authors by their registry."""
    keys = registries(spark, target_dir)
    one = F.lit(1).cast("long")
    dims = {
        "timeinfo": keys["year"].table().select("time_id", "year", one.alias("month"), one.alias("day"),
                                                decade("year").alias("decade")),
        "document_type": keys["type"].table().select("type_id", F.col("type").alias("name"),
                                                     F.lit(S.TYPE_DESCRIPTION).alias("description")),
        "author": keys["author"].table().select("author_id", F.col("author").alias("name")),
    }
    pubs, cols = staged_tables(spark, target_dir)
    dims["venue_series"] = cols.select(F.col("id").alias("venue_series_id"), F.col("title").alias("name"),
                                       F.col("key").alias("dblp_key"))
    return build_star(adapter.staged_from_records(pubs, cols), dims=dims)
