"""Row numbers and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gondola.operators import scale


def number_rows(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """1..n (bigint) in every group by `order`, which must identify a row within its group.

    One range exchange over group and order deals the rows out, so that a huge group, or one
    value that most of it shares, is split over as many tasks as its rows need. The rows are kept
    with their place in their partition: a task that runs again finds the same places. A group's
    part of a partition is numbered from there, shifted by the group's rows in earlier
    partitions, of which there is one line each. `rows` is read twice, for the ranges and for the
    exchange; pass stored rows where it is expensive.
    """
    dealt = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    placed = scale.cut(dealt.withColumn("_lugar", F.monotonically_increasing_id()))
    part = F.shiftright("_lugar", 33)
    parts = placed.groupBy(*group, part.alias("_parte")).agg(F.min("_lugar").alias("_primero"), F.count("*").alias("_filas"))
    earlier = Window.partitionBy(*group).orderBy("_parte").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_filas").over(earlier), F.lit(0)) - F.col("_primero") + 1
    shifts = parts.select(*[F.col(c).alias(f"_de_{c}") for c in group], "_parte", shift.alias("_salto"))
    same = [F.col(c).eqNullSafe(F.col(f"_de_{c}")) for c in group] + [part == F.col("_parte")]
    return placed.join(shifts, same).select(*rows.columns, (F.col("_lugar") + F.col("_salto")).alias(name))


def top(rows: DataFrame, k: int, *order) -> DataFrame:
    return rows.orderBy(*order).limit(k)


def frequency(rows: DataFrame, columns: list[str], k: int | None = None, name: str = "cantidad") -> DataFrame:
    """Rows per value combination, most frequent first; null is a value. With k only the
    first k, ties going to the smaller value."""
    counts = rows.groupBy(*columns).agg(F.count("*").alias(name))
    return counts if k is None else top(counts, k, F.desc(name), *columns)


def in_top_groups(rows: DataFrame, column: str, k: int) -> DataFrame:
    """Rows of the k most frequent values of a column. The k names are broadcast."""
    known = rows.filter(F.col(column).isNotNull())
    leaders = frequency(known, [column], k).select(column)
    return known.join(F.broadcast(leaders), column, "left_semi")
