"""Helpers that the operators share: tables, lineage cuts, guarded broadcasts, label folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gondola.operators.scale import cut, shared_folder

__all__ = ["WORD", "BROADCAST_ROWS", "by_batch", "cut", "fold", "free", "labelled_sample", "shared_folder", "small", "table", "texts"]

#: Words of a text for every contract that does not say otherwise.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a few numbers each that may be broadcast; what has more rows is shuffled.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A frame that was cut, marked for broadcast if it has at most `rows` rows."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def fold(key: str, folds: int) -> Column:
    """crc32 of the key's text modulo `folds`; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """Documents with a usable label outside the held-out fold: (text, y), at most `rows` rows, one an id.

    The ids with the smallest hashes are taken, so the sample is the same in each run. It bounds what
    fitting costs; scoring is never sampled. An id with several labels has its largest, one with
    several texts that of the smallest hash, so an id that a third of all rows share is one row too.
    """
    usable = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & (fold(key, folds) != held))
        .groupBy(key).agg(F.max(label).alias("_y"))
        .orderBy(F.xxhash64(key), key)
        .limit(rows)
    )
    chosen = docs.select(key, "text").join(F.broadcast(usable), key)
    one = chosen.groupBy(key, "_y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("text", F.col("_y").alias("y"))


def free(frame: DataFrame, name: str) -> str:
    """The name, with as many underscores after it as it takes to be no column's."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(column: pa.Array) -> Iterator[str]:
    """The texts of an Arrow column; a null is an empty one, and bytes that are not UTF-8 are read as U+FFFD."""
    for value in column.cast(pa.large_binary()):
        yield (value.as_py() or b"").decode("utf-8", "replace")


def by_batch(frame: DataFrame, added: str, schema: str, work: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """The frame and, last, a struct column `added` made per Arrow batch by `work` (one array a field).

    The struct keeps the new values apart from input columns of the same names; a column that is
    itself called `added` is replaced.
    """
    frame = frame.drop(added)
    kind = T.StructType.fromDDL(schema)
    out = T.StructType([*frame.schema.fields, T.StructField(added, kind, False)])
    names = kind.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                new = pa.StructArray.from_arrays(work(batch), names=names)
                yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, added])

    return frame.mapInArrow(run, out)
