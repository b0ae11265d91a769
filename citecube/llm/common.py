"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..session import scratch_path  # noqa: F401  (general helper, re-exported)

# ASCII white space: the word separator of every operator here.
SPACE = r"[\x20\x09-\x0D]+"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


BATCH_ROWS = 1000   # texts that go to a Python worker at once, at most
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is planned inside sends texts to Python in batches of BATCH_ROWS: the
    default, 10,000 rows, is a whole partition of texts, held in the executor
    and in the worker besides the heap."""
    rows = spark.conf.get(_ROWS)
    if 0 < int(rows) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(_ROWS, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_ROWS, rows)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """As elsewhere, with the codec that asks for the least memory and time."""
    return session.materialize(df, name, codec="snappy")


def materialize_texts(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The same for a step that sends texts, or what is as large, to Python: in
    small batches."""
    with small_batches(df.sparkSession):
        return session.materialize(df, name, codec)


def settle(df: DataFrame, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``session.settle`` in the session of ``df``."""
    return session.settle(df.sparkSession, make, name, materialize)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(col: str | Column) -> Column:
    """UTF-8 bytes of a text; null counts as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= MIX_1
        x ^= x >> np.uint64(27)
        x *= MIX_2
        x ^= x >> np.uint64(31)
    return x


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two hash arrays."""
    with np.errstate(over="ignore"):
        return mix64(left * GOLDEN + (right ^ (right >> np.uint64(29))) * MIX_2 + MIX_1)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order (words end at ASCII
    white space; ``bytes.split`` uses exactly that set)."""
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (empty when there are
    fewer).  Runs are built by doubling, so the cost is log2(n) passes."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    run, have = mix64(words + GOLDEN), 1
    while have < n:
        step = min(have, n - have)
        run = pair_hash(run[:len(run) - step], run[step:])
        have += step
    return run


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; with fewer words the
    whole sequence is the one shingle; without words the set is empty."""
    words = word_hashes(text)
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(words, min(n, len(words))))


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as Spark's long."""
    return x.view(np.int64)


def blocks(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``max_bytes`` at most (one
    longer text stands alone)."""
    sizes = np.array(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    total, lo = 0, 0
    for i, n in enumerate(sizes):
        if total + n > max_bytes and i > lo:
            yield batch.slice(lo, i - lo)
            total, lo = 0, i
        total += int(n)
    if lo < len(sizes):
        yield batch.slice(lo)
