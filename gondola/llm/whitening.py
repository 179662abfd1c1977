"""Embedding whitening (11) with MLlib's distributed block matrices.

Entries become whole numbers, floor(`scale` * c), so that equal vectors are equal exactly. The mean and the
covariance are those of the fit list, each distinct vector once.

1. The usable rows are written with a dense index: a row's place in its partition, moved by the sizes of the
   partitions before. So is the fit list.
2. Sums and count of the fit list are exact. Its rows, less the mean, become a BlockMatrix X.
3. X' * X, summed over `splits` parts of the rows, is the scatter. Only this matrix, of as many rows and columns as
   a vector has entries, comes to the driver for its eigenvectors.
4. All rows, less the mean, are a BlockMatrix again and are multiplied by the whitening matrix, which has a
   column for each component. The products go back to their rows by the index, which no two rows share.
5. The same is done with the fit list; the covariance of the products shows how close they are to white.

A vector that a third of the rows share is one row of the fit list after a map-side aggregation and never
meets in one task. A block has at most `BLOCK` bytes. MLlib lists the blocks' places on the driver (not
the blocks): some 100 bytes for each `BLOCK` bytes of vectors.

Defined results: rows are left out whose vector is null, empty, or has null or non-finite entries, and rows
whose vector has not the most frequent length (of equally frequent ones the largest). Components without
variance (an eigenvalue below `ZERO` of the largest) are left out; with one distinct vector, or none, there are
no components. Entries beyond 64 bits are cut to them. Repeated rows and null ids stay, each on its own.
The other columns come back in one struct, `row`, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window, functions as F

from gondola.llm.common import cut

#: Bytes of a block at most, and rows of one at least.
BLOCK, LEAST = 1 << 24, 256
#: Entries of a vector at most: the scatter matrix is held by the driver.
WIDEST = 4096
ZERO = 1e-12


def whole(rows: DataFrame, vector: str, scale: int) -> DataFrame:
    """The usable rows as (row, x): all columns, and floor(scale * c) of each entry."""
    strange = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    usable = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~strange)
    return usable.select(F.struct(*[F.col(c) for c in rows.columns]).alias("row"), x.alias("x"))


def indexed(frame: DataFrame) -> DataFrame:
    """The frame, written, with `at`: 0, 1, 2 and so on. The order of rows is that of their partitions."""
    kept = cut(frame.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = kept.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row for each partition
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = cut(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start")))
    at = F.col("_start") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return kept.join(F.broadcast(starts), part == F.col("_part")).select(*frame.columns, at.alias("at"))


def sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the exact sum of each entry."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, high, low = 0, [0] * size, [0] * size
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            rows += len(x)  # halves of 32 bits: a batch's sums cannot overflow
            high = [a + b for a, b in zip(high, (x >> 32).sum(0).tolist())]
            low = [a + b for a, b in zip(low, (x & 0xFFFFFFFF).sum(0).tolist())]
        if rows:
            total = [str((a << 32) + b) for a, b in zip(high, low)]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, size)), pa.array([str(rows), *total])], ["entry", "total"])

    parts = fit.select("x").mapInArrow(work, "entry long, total string")
    found = dict(parts.groupBy("entry").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect())
    return int(found.get(-1, 0)), [int(found.get(k, 0)) for k in range(size)]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, size)


def _blocks(rows: DataFrame, mean: np.ndarray, count: int) -> BlockMatrix:
    """The vectors (at, x) of `count` rows, less the mean, as a block matrix."""
    size = len(mean)
    centre = F.array(*[F.lit(float(m)) for m in mean])
    centred = F.zip_with("x", centre, lambda c, m: c.cast("double") - m)
    frame = rows.select(F.col("at").cast("long").alias("index"), array_to_vector(centred).alias("vector"))
    return _block_matrix(frame, count, size)


def _block_matrix(frame: DataFrame, count: int, size: int) -> BlockMatrix:
    spread = 2 * frame.sparkSession.sparkContext.defaultParallelism
    height = int(min(max(BLOCK // (8 * size), 1), max(LEAST, -(-count // spread))))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(frame, "vector"), count, size)
    return matrix.toBlockMatrix(height, size)


def _scatter(x: BlockMatrix, splits: int) -> np.ndarray:
    """X' * X. Its rows' blocks are dealt over `splits` tasks, each of which sums its own products first."""
    # the Scala method's last argument, which the Python one does not pass on
    product = x.transpose()._java_matrix_wrapper.call("multiply", x._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, x.colsPerBlock, x.colsPerBlock).toLocalMatrix().toArray()


def _splits(x: BlockMatrix) -> int:
    blocks = -(-x.numRows() // x.rowsPerBlock)
    return int(min(blocks, 4096))


def _project(x: BlockMatrix, weights: np.ndarray, spark) -> DataFrame:
    """(at, z) of the rows of x times the weights."""
    size, count = weights.shape
    local = spark.sparkContext.parallelize([((0, 0), DenseMatrix(size, count, weights.ravel("F").tolist()))], 1)
    product = x.multiply(BlockMatrix(local, size, count, size, count))
    rows = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("at"), vector_to_array("vector").alias("z"))


@dataclass
class Whitening:
    """What the fit list says: a column of `weights` for each component, of which the first are the largest."""

    count: int
    sums: list[int]
    weights: np.ndarray
    explained: list[float]
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.count for s in self.sums])


def fit(vectors: DataFrame, size: int, components: int) -> Whitening | None:
    """Whitening of the distinct vectors x; None if they have no variance."""
    spark = vectors.sparkSession
    rows = indexed(vectors.select("x").distinct())
    count, total = sums(rows, size)
    if count < 2:
        return None
    mean = np.array([s / count for s in total])
    x = _blocks(rows, mean, count)
    value, vector = np.linalg.eigh(_scatter(x, _splits(x)) / count)
    order = np.argsort(-value, kind="stable")
    value, vector = value[order], vector[:, order]
    used = min(components, int((value > ZERO * max(value[0], 0)).sum()))
    if not used:
        return None
    weights = vector[:, :used] / np.sqrt(value[:used])
    z = cut(_project(x, weights, spark))
    middle = z.select(F.posexplode("z")).groupBy("pos").agg(F.avg("col").alias("m")).collect()
    middle = np.array([r.m for r in sorted(middle)])
    centred = F.zip_with("z", F.array(*[F.lit(float(m)) for m in middle]), lambda c, m: c - m)
    y = _block_matrix(z.select(F.col("at").alias("index"), array_to_vector(centred).alias("vector")), count, used)
    error = np.abs(_scatter(y, _splits(y)) / count - np.eye(used)).max()
    return Whitening(count, total, weights, (value[:used] / value.sum()).tolist(), float(error))


def deviations(rows: DataFrame, total: list[int], count: int) -> DataFrame:
    """The rows (at, row, x) as (at, row, deviation): the exact sum of (count * x - total)^2, as decimal."""
    size = len(total)
    kind = f"at long, row {rows.schema['row'].dataType.simpleString()}, deviation decimal(38,0)"
    far = max(map(abs, total), default=0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), size)
            most = count * max(abs(int(x.max())), abs(int(x.min()))) + far
            if size * most * most < 1 << 63:
                found = ((count * x - np.array(total, dtype=np.int64)) ** 2).sum(1).tolist()
            else:  # beyond 64 bits
                found = [sum((count * a - s) ** 2 for a, s in zip(row, total)) for row in x.tolist()]
            found = pa.array([str(f) if f < 10**38 else None for f in found], pa.string()).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("row"), found], ["at", "row", "deviation"])

    return rows.select("at", "row", "x").mapInArrow(work, kind)


def whiten(rows: DataFrame, *, vector: str = "embedding", scale: int = 256, components: int = 4) -> DataFrame:
    """(row, component, n, deviation, whitened, explained, identity_error) of each usable row and component.

    `row` has the input's columns. `deviation` is a decimal (null from 10^38 on); `n` is the size of the fit list.
    """
    spark = rows.sparkSession
    usable = whole(rows, vector, scale)
    sizes = usable.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes.size if sizes else 1
    if size > WIDEST:
        raise ValueError(f"vectors of {size} entries; at most {WIDEST}")
    placed = indexed(usable.where(F.size("x") == size))
    model = fit(placed, size, components)
    kind = f"row {placed.schema['row'].dataType.simpleString()}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], kind)
    total = placed.count()
    z = _project(_blocks(placed, model.mean, total), model.weights, spark)
    told = deviations(placed, model.sums, model.count).join(z, "at")
    share = F.array(*[F.lit(e) for e in model.explained])
    return told.select(
        "row", F.lit(model.count).cast("bigint").alias("n"), "deviation", F.lit(model.identity_error).alias("identity_error"),
        F.posexplode("z").alias("_k", "whitened"),
    ).select(
        "row", (F.col("_k") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.element_at(share, F.col("_k") + 1).alias("explained"), "identity_error",
    )
