"""Session settings the jobs rely on, and the size check behind every broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when a measuring pass finds it within both bounds.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024

#: Rows carry whole pages and article texts, so Arrow batches stay small.
BATCH_ROWS = 500

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    # Noting the caller of every column function costs more than planning the page rules does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings above to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of a session that was configured otherwise small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def fits_broadcast(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> bool:
    """Measure `df` in one distributed pass: only two numbers reach the driver."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_bounded(df: DataFrame, **bounds: int) -> DataFrame:
    """Hint a broadcast when `df` is measured small, else leave a shuffle join."""
    return F.broadcast(df) if fits_broadcast(df, **bounds) else df


def spread(df: DataFrame) -> DataFrame:
    """Use every core on an input that has fewer splits than there are cores.

    Such an input is small, so moving it is cheap next to parsing it. A large
    one has splits to spare and is left where it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below `spark.checkpoint.dir`, which only local mode may leave unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "articlelake")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
