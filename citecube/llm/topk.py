"""Exact top-k inner-product search by columnar branch and bound.

Queries and candidates meet in tiles: a tile holds a bounded strip of the
candidates and a bounded group of the queries, so memory does not grow with
either.  In a tile the candidates lie dimension by dimension.  For one query
the dimensions are taken in blocks, largest query components first; after each
block a candidate's score so far plus the product of the remaining masses
bounds what it can still reach (Cauchy-Schwarz), and candidates that cannot
reach the k-th best are compacted away.  Tiles return their k best per query;
a window over the query merges them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRIP = 16384       # candidates of a tile
GROUP = 1024        # queries of a tile
DIM_BLOCK = 8
EXACT = 2.0**52     # whole numbers below it add up exactly as float64
LONG_MAX = 2**63 - 1


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as float64 where that is exact, else as Python ints."""
    with np.errstate(over="ignore"):
        y = np.floor(scale * x)
    if not y.size or np.abs(y).max() < EXACT:
        return y
    exact = [int(v) * scale if abs(v) >= EXACT else math.floor(scale * v) for v in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def search(query: np.ndarray, columns: np.ndarray, mass: np.ndarray, ids: np.ndarray, own: int,
           k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k best columns, ties to the smaller id."""
    alive = np.flatnonzero(ids != own)
    score, rest = np.zeros(len(alive)), mass[alive].copy()
    order = np.argsort(-np.abs(query), kind="stable")
    left = float((query * query).sum())
    for lo in range(0, len(order), DIM_BLOCK):
        dims = order[lo:lo + DIM_BLOCK]
        part = columns[dims][:, alive] if len(alive) < columns.shape[1] // 2 else columns[dims].take(alive, axis=1)
        score += query[dims] @ part
        rest -= (part * part).sum(axis=0)
        left -= float((query[dims] ** 2).sum())
        if len(alive) > k and lo + DIM_BLOCK < len(order):
            reach = np.sqrt(np.maximum(rest, 0.0) * max(left, 0.0)) * (1 + 1e-9) + 1.0   # rounded up
            floor = np.partition(score - reach, len(alive) - k)[len(alive) - k]          # k-th best lower bound
            keep = score + reach >= floor
            if not keep.all():
                alive, score, rest = alive[keep], score[keep], rest[keep]
    best = np.lexsort((ids[alive], -score))[:k]
    return alive[best], score[best]


def search_plain(query: np.ndarray, columns: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[list, list]:
    """The same with Python's whole numbers, for components beyond float64."""
    def score(j: int) -> int:
        return max(-LONG_MAX - 1, min(LONG_MAX, sum(int(a) * int(b) for a, b in zip(query, columns[:, j]))))

    found = sorted((-score(j), int(ids[j]), j) for j in range(len(ids)) if ids[j] != own)[:k]
    return [j for _, _, j in found], [-s for s, _, _ in found]


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where ``is_query`` holds,
    the ``k`` other rows with the largest inner product of floor(scale * x).

    Ties go to the smaller id.  A null vector, or one with a null or non-finite
    component, and a null id take no part; vectors are compared with those of
    their own length.  Rows that repeat an id are candidates each, but never
    for their own id; as a query an id counts once, by its smallest vector.
    Scores beyond a long are clipped to it and ranked so.  Fewer candidates
    give fewer rows; an empty table gives none; extra columns are ignored."""
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), is_query.alias("asks"),
                           F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(usable))
    queries = rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    strips = max(1, -(-rows.count() // STRIP))
    groups = max(1, -(-queries.count() // GROUP))
    # Every strip meets every group of queries once.
    left = (rows.select("id", "vector", F.pmod(F.xxhash64("id", "vector"), F.lit(strips).cast("long")).alias("strip"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group")))
    right = (queries.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(groups).cast("long")).alias("group"),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(strips - 1).cast("long"))).alias("strip")))

    def by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        ids = table.column("id").to_numpy()
        lists = table.column("vector").combine_chunks()
        sizes = np.asarray(lists.value_lengths())
        flat, offsets = np.asarray(lists.flatten()), np.concatenate(([0], np.cumsum(sizes)))
        out = {}
        for d in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == d)
            out[d] = ids[at], scaled(flat[offsets[at][:, None] + np.arange(d)], scale)
        return out

    def tile(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        q, v, s = [], [], []
        have = by_length(candidates) if candidates.num_rows else {}
        for d, (asking, questions) in (by_length(asked) if asked.num_rows else {}).items():
            if d not in have:
                continue
            ids, matrix = have[d]
            columns = np.ascontiguousarray(matrix.T)
            small = matrix.dtype != object and questions.dtype != object and (
                d == 0 or max(1.0, np.abs(matrix).max(), np.abs(questions).max()) ** 2 * d < EXACT)
            mass = (columns * columns).sum(axis=0) if small else None
            for own, question in zip(asking.tolist(), questions):
                at, score = (search(question, columns, mass, ids, own, k) if small
                             else search_plain(question, columns, ids, own, k))
                q += [own] * len(at)
                v += ids[at].tolist()
                s += [int(x) for x in score]
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()),
                         "score": pa.array(s, pa.int64())})

    partial = (left.groupBy("strip", "group").cogroup(right.groupBy("strip", "group"))
               .applyInArrow(tile, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
