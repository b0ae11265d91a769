"""Exact dedup by progressive refinement: length, then prefix hash, then full
hash.  Full contents are hashed only for documents whose length and prefix
both occur again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, materialize

PREFIX_CHARS = 256


def normalised(text_col: str | Column) -> Column:
    """Each run of ASCII white space becomes one space; null counts as empty."""
    col = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.regexp_replace(F.coalesce(col, F.lit("")), SPACE, " ")


def digest(text_col: str | Column) -> Column:
    return F.sha2(normalised(text_col), 256)


def _recurring(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur more than once.  The counted keys are written
    first, so both join inputs are plain exchanges and a hot key is split."""
    often = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                        .where("_n > 1").drop("_n"), "exact-keys")
    return rows.join(often, keys, "left_semi")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts that occur more than once: (full, keep_id, group_size), with the
    SHA-256 of the normalised text, the smallest id and the number of rows.

    Null, missing and empty texts are equal to each other.  Rows that repeat an
    id, and rows without one, count one by one; a null id is never the smallest,
    and its row's ``kept`` is null.  An empty table gives no groups; extra columns of any
    name are ignored."""
    prints = materialize(
        docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("_t"))
        .select("id", F.octet_length("_t").alias("size"),
                F.xxhash64(F.substring("_t", 1, PREFIX_CHARS)).alias("prefix")), "exact-prints")
    same_length = _recurring(prints, ["size"])
    survivors = materialize(_recurring(same_length, ["size", "prefix"]).select(F.col("id").alias("_s")).distinct(), "exact-survivors")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_t"))
    full = rows.join(survivors, rows["id"].eqNullSafe(survivors["_s"]), "left_semi").select("id", digest("_t").alias("full"))
    return materialize(full.groupBy("full").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                       .where("group_size > 1"), "exact-groups")


def exact_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256).
    Rows that repeat the smallest id of a group all count as that document and
    are all kept."""
    groups = exact_groups(docs, id_col, text_col)
    return (docs.select(F.col(id_col).alias("id"), digest(text_col).alias("full"))
            .join(groups, "full", "left")
            .select("id", F.coalesce("keep_id", "id").alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    (F.coalesce("keep_id", "id") == F.col("id")).alias("kept"),
                    F.col("full").alias("text_sha256")))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts
    one row, with the smallest id.  Each row is judged by its own text; rows
    with a null id all stay."""
    groups = exact_groups(docs, id_col, text_col)
    id_of, h_of = F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))
    # Judged by ids and hashes; whole rows are moved once, to meet those that go.
    keys = docs.select(id_of.alias("_id"), h_of.alias("_h"), digest(F.col(f"`{text_col}`")).alias("full")).where("_id IS NOT NULL")
    copies = materialize(keys.join(groups.select("full", "keep_id"), "full")
                         .groupBy("_id", "full").agg(F.min("_h").alias("first"), F.collect_set("_h").alias("hs"),
                                                     F.count(F.lit(1)).alias("n"), F.first("keep_id").alias("keep_id")), "exact-copies")
    twins = materialize(copies.where("_id = keep_id AND n > 1").select("_id", F.col("first").alias("_h")), "exact-twins")
    gone = materialize(copies.where("_id != keep_id OR n > 1").select("_id", F.explode("hs").alias("_h")), "exact-gone")
    alone = docs.join(gone, (id_of == F.col("_id")) & (h_of == F.col("_h")), "left_anti")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = (docs.select(whole.alias("row"), id_of.alias("_id"), h_of.alias("_h")).join(twins, ["_id", "_h"])
            .groupBy("_id", "_h").agg(F.first("row").alias("row")))     # of rows that repeat both id and text
    return alone.union(kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
