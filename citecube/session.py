"""Session helpers: a local session for tests and tools, and the shared
checkpoint / scratch folder taken from the session configuration."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections import deque
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast when a side turns out small), coalesces small
# shuffle partitions and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "citecube") -> SparkSession:
    """Session for tests, bench and command-line use (local mode)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (shared
    storage).  Only in local mode, as in unit tests, a temporary folder is
    created where nothing is configured; on a cluster that is an error, as
    executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="citecube-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written
    intermediate tables (never a machine-local temp folder on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "citecube", f"{name}-{uuid.uuid4().hex[:12]}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# Where ``settle`` learns which tables were written while it made one.
_ON_THE_WAY: ContextVar[list[str]] = ContextVar("written", default=deque(maxlen=0))


def settle(spark: SparkSession, make, name: str, write=None):
    """The frame that ``make()`` returns, written; the tables that were
    materialized on the way to it are deleted.  For a small result of large
    intermediate tables, of which nothing else is returned."""
    written: list[str] = []
    token = _ON_THE_WAY.set(written)
    try:
        out = make()
    finally:
        _ON_THE_WAY.reset(token)
    out = (write or materialize)(out, name)
    for path in written:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return out


def materialize(df, name: str = "stage", codec: str = "zstd"):
    """Write ``df`` once as parquet into the shared checkpoint folder and read
    it back: lineage is cut, the data survive executor loss, and later scans
    prune columns and push filters (an RDD checkpoint would do neither).  Zstandard
    keeps what is written once and read once or twice small."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _ON_THE_WAY.get().append(path)
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return spark.read.parquet(path)


# Rows of a written table up to which a join may send it to every executor (some 50 MB in the driver).
BROADCAST_ROWS = 500_000


def join_side(df):
    """A written table as a side of a join.  Spark plans a broadcast from the
    bytes on disk, where millions of narrow rows may take a few megabytes, but the
    driver holds them unpacked.  So a table of more than BROADCAST_ROWS rows is
    joined by a shuffle; of smaller ones Spark decides.  Only counts are read."""
    return df.hint("merge") if df.count() > BROADCAST_ROWS else df
