"""Surrogate keys that stay: a growing table natural key -> id.

``dense_ids`` numbers a whole table; when records arrive day by day, an id that
was given once must never change.  A registry keeps one folder per batch.  A
batch gives ids only to keys that no earlier batch has (an anti-join), from the
highest id on, in the order of the keys.  A batch reads earlier batches only and
replaces its own folder, so a replay after a failure gives the same ids again."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import join_side
from .keys import dense_ids


class KeyRegistry:
    """Ids of the distinct values of ``key_cols`` (``schema``: their fields),
    stored under ``path``.  Batches are numbered in the order of arrival.  Rows
    with a null in a key get no id."""

    def __init__(self, spark: SparkSession, path: str, key_schema: T.StructType, id_col: str):
        self.spark, self.path, self.id_col = spark, path, id_col
        self.keys = [f.name for f in key_schema]
        self.schema = T.StructType([*key_schema, T.StructField(id_col, T.LongType())])
        spark.createDataFrame([], self.schema).write.mode("ignore").parquet(self._folder(-1))

    def _folder(self, batch: int) -> str:
        return os.path.join(self.path, f"batch={batch}")

    def table(self, before: int | None = None) -> DataFrame:
        """(keys, id, batch) of all batches, or of those before one."""
        schema = T.StructType([*self.schema, T.StructField("batch", T.LongType())])
        known = self.spark.read.schema(schema).parquet(self.path)
        return known if before is None else known.where(F.col("batch") < before)

    def assign(self, rows: DataFrame, batch: int) -> DataFrame:
        """Register the keys of a batch's rows; returns the newly given ids."""
        known = self.table(batch)
        fresh = rows.select(*self.keys).dropna().distinct().join(join_side(known.select(*self.keys)), self.keys, "left_anti")
        last = known.agg(F.max(self.id_col)).first()[0] or 0
        given = dense_ids(fresh, self.keys, self.id_col, first_id=last + 1)
        given.select(*self.keys, self.id_col).write.mode("overwrite").parquet(self._folder(batch))
        return self.spark.read.schema(self.schema).parquet(self._folder(batch))
