"""Corpus pipeline: quality, exact dedup, near-dedup, substring dedup, packing.

Each stage works on all that the one before kept.  The first four return the
columns of ``documents``; the last returns the packed pieces.  Nulls, empty
texts, repeated rows, empty tables and extra columns are handled as the
operators' docstrings say; rows with a null id are never dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citecube.llm import exact, neardup, packing, quality, substring
from citecube.llm.common import materialize, read_table

ORACLE_SQL = None  # the quality model has no SQL form; tests hold each stage against brute force

REJECT_BELOW = quality.REJECT_BELOW
NEAR_WORDS, NEAR_PERCENT = 5, 80
REPEAT_WORDS = 35    # words of a repeated passage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.  It learns from the
    labelled documents outside the held-out fold."""
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"), usable=~quality.in_fold())
    return quality.drop_poor(docs, weights, REJECT_BELOW)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts only one row, with the smallest id, goes on."""
    return exact.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies only one row, with the smallest id, goes on."""
    return neardup.drop_near(docs, NEAR_WORDS, NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur elsewhere are cut out of every text.  Texts that
    lose nothing stay as they are; texts of which nothing is left go."""
    return substring.cut_repeats(docs, REPEAT_WORDS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [("quality classifier", keep_good), ("exact dedup", drop_copies), ("near-dedup", drop_near_copies),
          ("substring dedup", cut_repeats), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
