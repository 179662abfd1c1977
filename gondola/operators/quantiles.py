"""Exact interpolated quantiles without bringing a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gondola.functions import measures
from gondola.operators import scale

# The sketch's accuracy: its rank error is at most rows / ACCURACY. Cells that a bracket is cut into.
ACCURACY = 20_000
STEPS = 2_000
# Size of a stored KLL sketch, and the distance at which its values bracket a rank: some four times the error that
# 99 of 100 sketches of that size keep within. The cell of values outside of all brackets.
KLL, SLACK = 4_096, 0.005
OUTSIDE = -1

FIGURES = ("n", "media", "desviacion", "minimo", "maximo")


def attach(rows: DataFrame, figures: DataFrame, by: list[str]) -> DataFrame:
    """The rows with their group's figures; without groups a scalar subquery, not a join."""
    if by:
        return rows.join(figures, by)
    found = figures.select(F.struct("*")).scalar()
    return rows.withColumns({c: found[c] for c in figures.columns})


def _brackets(n: Column, sketch: Column, count: int, accuracy: int) -> Column:
    """Per probability the values (lo, hi) between which its rank lies. In groups of few rows, where the
    sketch's error is no whole rank, that is everything."""
    few = n < 4 * accuracy
    ends = lambda k: (F.when(few, F.col("minimo")).otherwise(sketch[2 * k]), F.when(few, F.col("maximo")).otherwise(sketch[2 * k + 1]))
    return F.array(*[F.struct(lo.alias("lo"), hi.alias("hi")) for lo, hi in map(ends, range(count))])


def _cell(value: Column, count: int, steps: int) -> tuple[Column, Column]:
    """(zone, cell) of a value: both rise with it, and a value outside of all brackets has no cell.

    Zones are what the ends of the brackets part the line into; in a zone, the first bracket around
    it is cut into equal steps."""
    zone, cell = F.lit(0), F.lit(None).cast("int")
    for k in reversed(range(count)):
        lo, hi = F.col("_w")[k]["lo"], F.col("_w")[k]["hi"]
        zone = zone + (value >= lo).cast("int") + (value > hi).cast("int")
        cell = F.when((value >= lo) & (value <= hi), measures.bin_index(value, lo, hi, steps)).otherwise(cell)
    return zone, cell


def exact_quantiles(
    rows: DataFrame, value: str, probabilities: list[float], by: list[str], count: int = STEPS, accuracy: int = ACCURACY
) -> DataFrame:
    """One row per group: FIGURES and `cuantiles`, an array with one linearly interpolated
    quantile per probability. Nulls and NaN are left out.

    Two passes over the rows, for every size. The first takes the figures and a sketch, whose
    values a little below and above each probability bracket its rank: the distance is twice the
    sketch's error. The second counts each row once, by its value inside a bracket and by its zone
    outside, map-side first; a bracket holds some 4 in ACCURACY of a group. What was counted is kept, and cut
    into `count` cells a bracket: a running count over the cells finds the one with the rank, and only
    that cell's values are walked in order. So neither a group nor a bracket is sorted by one task.
    """
    slack = 2 / accuracy
    order = sorted(set(map(float, probabilities)))
    shares = [min(max(p + d, 0.0), 1.0) for p in order for d in (-slack, slack)]
    data = rows.filter(measures.is_number(F.col(value))).select(*by, F.col(value).cast("double").alias("_v"))
    sketch = F.percentile_approx("_v", F.array(*map(F.lit, shares)), accuracy)
    figures = data.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg("_v").alias("media"),
        F.stddev_samp("_v").alias("desviacion"),
        F.min("_v").alias("minimo"),
        F.max("_v").alias("maximo"),
        sketch.alias("_s"),
    ).filter("n > 0")
    figures = scale.cut(figures if by else figures.withColumn("_g", F.lit(0)))
    brackets = _brackets(F.col("n"), F.col("_s"), len(order), accuracy)
    return _walk(data, figures.withColumn("_w", brackets), probabilities, by, count).select(*by, *FIGURES, "cuantiles")


def _counted(data: DataFrame, figures: DataFrame, brackets: int, by: list[str], count: int) -> DataFrame:
    """The rows counted by zone, cell and value inside a bracket, kept; `_m` is the lowest value."""
    keys = by or ["_g"]
    zone, cell = _cell(F.col("_v"), brackets, count)
    placed = attach(data, figures.select(*by, "_w"), by).select(*by, "_v", zone.alias("_zona"), cell.alias("_celda"))
    counted = (
        placed.groupBy(*by, "_zona", "_celda", F.when(F.col("_celda").isNotNull(), F.col("_v")).alias("_x"))
        .agg(F.count("*").alias("_filas"), F.min("_v").alias("_m"))
    )
    counted = scale.cut(counted if by else counted.withColumn("_g", F.lit(0)))
    return counted.select(*keys, "_zona", F.coalesce("_celda", F.lit(OUTSIDE)).alias("_celda"), "_filas", "_m")


def _reached(counted: DataFrame, figures: DataFrame, probabilities: list[float], keys: list[str]) -> DataFrame:
    """The cells that hold the ranks on both sides of each quantile."""
    cells = counted.groupBy(*keys, "_zona", "_celda").agg(F.sum("_filas").alias("_filas"))
    earlier = Window.partitionBy(*keys).orderBy("_zona", "_celda").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_antes", F.coalesce(F.sum("_filas").over(earlier), F.lit(0)))
    wanted = [
        F.struct(F.lit(i).alias("_i"), F.lit(d).alias("_d"), (F.floor(_position(p)) + d).alias("_rango"))
        for i, p in enumerate(probabilities) for d in (0, 1)
    ]
    ranks = figures.select(*keys, F.inline(F.array(*wanted)))
    return cells.join(ranks, keys).filter("_antes <= _rango AND _rango < _antes + _filas").drop("_filas")


def _position(probability: float) -> Column:
    return F.lit(float(probability)) * (F.col("n") - 1)


def _walk(data: DataFrame, figures: DataFrame, probabilities: list[float], by: list[str], count: int, sure: bool = True) -> DataFrame:
    """The figures with `cuantiles`, from one pass over the rows (by, _v).

    `_w` brackets the ranks of the probabilities in order. If they are not `sure` to, groups in which a
    rank fell outside get everything as a bracket, in a second pass."""
    keys = by or ["_g"]
    brackets = len(set(map(float, probabilities)))
    counted = _counted(data, figures, brackets, by, count)
    reached = _reached(counted, figures, probabilities, keys)
    if not sure and not (missed := reached.filter((F.col("_celda") == OUTSIDE) & (F.col("_d") == 0))).isEmpty():
        wide = F.array(*[F.struct(F.col("minimo").alias("lo"), F.col("maximo").alias("hi"))] * brackets)
        lost = missed.select(*keys).distinct().withColumn("_mal", F.lit(True))
        figures = scale.cut(figures.join(lost, keys, "left").withColumn("_w", F.when(F.col("_mal"), wide).otherwise(F.col("_w"))).drop("_mal"))
        counted = _counted(data, figures, brackets, by, count)
        reached = _reached(counted, figures, probabilities, keys)
    upto = Window.partitionBy(*keys, "_i", "_d").orderBy("_m").rowsBetween(Window.unboundedPreceding, 0)
    walked = reached.join(counted, [*keys, "_zona", "_celda"]).withColumn("_hasta", F.col("_antes") + F.sum("_filas").over(upto))
    at = lambda d: F.min(F.when((F.col("_hasta") > F.col("_rango")) & (F.col("_d") == d), F.col("_m")))
    found = walked.groupBy(*keys, "_i").agg(at(0).alias("_a"), at(1).alias("_c"))
    gathered = found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_a", "_c"))).alias("_q"))
    between = []
    for i, p in enumerate(probabilities):
        low, step = F.col("_q")[i]["_a"], F.col("_q")[i]["_c"] - F.col("_q")[i]["_a"]
        between.append(low + (_position(p) - F.floor(_position(p))) * F.coalesce(step, F.lit(0.0)))
    return figures.join(gathered, keys).withColumn("cuantiles", F.array(*between))


def states(rows: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Mergeable states of a column per group: n, lowest, highest and a KLL sketch."""
    numbers = rows.filter(measures.is_number(F.col(value))).withColumn("_v", F.col(value).cast("double"))
    sketch = F.kll_sketch_agg_double("_v", F.lit(KLL))
    return numbers.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("minimo"), F.max("_v").alias("maximo"), sketch.alias("estado"))


def quantiles_from_states(rows: DataFrame, value: str, probabilities: list[float], stored: DataFrame, by: list[str], count: int = STEPS) -> DataFrame:
    """One row per group: n, minimo, maximo and the exact `cuantiles` of the rows, whose states are
    `stored` under finer or the same groups. The merged sketches bracket the ranks, so the rows
    are read once; as a sketch may err by more than SLACK, though hardly ever, a group whose rank is not
    where its sketch says is counted again without a bracket."""
    order = sorted(set(map(float, probabilities)))
    merged = stored.filter("n > 0").groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo"), F.kll_merge_agg_double("estado").alias("_s"),
    ).filter("n > 0")
    at = lambda share: F.kll_sketch_get_quantile_double("_s", F.lit(min(max(share, 0.0), 1.0)))
    brackets = F.array(*[F.struct(at(p - SLACK).alias("lo"), at(p + SLACK).alias("hi")) for p in order])
    figures = scale.cut((merged if by else merged.withColumn("_g", F.lit(0))).withColumn("_w", brackets).drop("_s"))
    data = rows.filter(measures.is_number(F.col(value))).select(*by, F.col(value).cast("double").alias("_v"))
    return _walk(data, figures, probabilities, by, count, sure=False).select(*by, "n", "minimo", "maximo", "cuantiles")
