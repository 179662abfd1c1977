"""Size checks and lineage cuts shared by the other operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# A side is broadcast only when its measured size stays under this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024


def measure(frame: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a frame of strings and numbers, from one aggregate over it as it is now."""
    texts = [f.name for f in frame.schema if isinstance(f.dataType, T.StringType)]
    width = F.lit(16 * len(frame.columns)).cast("bigint")
    for name in texts:
        width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    rows, size = frame.agg(F.count("*"), F.sum(width)).first()
    return rows, size or 0


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for what a job writes on its way, from `spark.checkpoint.dir`.

    A session on this machine alone that names none (a test) gets one of its own; on a cluster
    that is an error, as executors would not find each other's files."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared folder: what is built on it reads these
    rows, whatever happens to the executors that made them."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()
