"""Exploration: value distributions, coverage, cardinalities, histograms, box plots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gondola.functions import measures
from gondola.operators import cube
from gondola.operators.facts import Mart
from gondola.operators.quantiles import attach, exact_quantiles


def daily_profile(mart: Mart) -> DataFrame:
    """Count and price figures per observation date."""
    days = cube.priced(cube.roll_up(cube.observations(mart), "fecha"), mart.price_scale, "fecha")
    return days.select(
        "fecha", F.col("num_observaciones").alias("cantidad_registros"),
        "precio_promedio", "precio_minimo", "precio_maximo",
    )


def category_profile(mart: Mart) -> DataFrame:
    """Count, average, extremes and sample standard deviation of prices per category.

    Observations are summed up per product before the catalogue is joined; the squares about a
    category's mean are those about its products' means and those of the means."""
    price = F.col("precio")
    products = mart.fact.groupBy("producto_id").agg(
        F.count("*").alias("filas"), F.count(price).alias("n"), measures.total(measures.units(price, mart.price_scale)).alias("total"),
        F.min(price).alias("bajo"), F.max(price).alias("alto"), F.avg(price).alias("media"), F.var_pop(price).alias("varianza"),
    )
    n, mean = F.col("n"), F.col("media")
    merged = mart.products.match(products, "categoria").groupBy("categoria").agg(
        F.sum("filas").alias("filas"), F.sum(n).alias("n"), measures.total(F.col("total")).alias("total"), F.min("bajo").alias("bajo"), F.max("alto").alias("alto"),
        F.sum(n * F.col("varianza")).alias("dentro"), F.sum(n * mean).alias("suma"), F.sum(n * mean * mean).alias("cuadrados"),
    )
    squares = F.greatest(F.col("dentro") + F.col("cuadrados") - F.col("suma") * F.col("suma") / n, F.lit(0.0))
    return merged.select(
        "categoria", F.col("filas").alias("cantidad_registros"), (measures.money(F.col("total"), mart.price_scale) / n).alias("precio_promedio"),
        F.col("bajo").alias("precio_minimo"), F.col("alto").alias("precio_maximo"), F.when(n > 1, F.sqrt(squares / (n - 1))).alias("desviacion_std"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [t.agg(F.count("*").alias("filas")).select(F.lit(n).alias("tabla"), "filas") for n, t in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def schema_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Position, type and number of filled values of every column of every table."""
    parts = []
    for name, rows in tables.items():
        filled = rows.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(rows.columns)])
        lines = [
            F.struct(
                F.lit(i + 1).alias("posicion"), F.lit(c).alias("columna"), F.lit(t).alias("tipo"),
                F.col(f"c{i}").alias("con_valor"),
            )
            for i, (c, t) in enumerate(rows.dtypes)
        ]
        parts.append(filled.select(F.lit(name).alias("tabla"), F.inline(F.array(*lines))))
    return reduce(DataFrame.unionAll, parts)


def cardinality(rows: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Distinct values per column, both without null and with null as a value."""
    measured = []
    for i, c in enumerate(columns):
        measured += [F.count_distinct(c).alias(f"d{i}"), F.count_if(F.col(c).isNull()).alias(f"n{i}")]
    lines = [
        F.struct(
            F.lit(c).alias("columna"),
            F.col(f"d{i}").alias("distintos"),
            (F.col(f"d{i}") + (F.col(f"n{i}") > 0).cast("bigint")).alias("distintos_con_nulo"),
        )
        for i, c in enumerate(columns)
    ]
    return rows.agg(*measured).select(F.lit(table).alias("tabla"), F.inline(F.array(*lines)))


def distinct_states(rows: DataFrame, keys: list[str], column: str, precision: int = 14) -> DataFrame:
    """Mergeable states of a column's distinct values per group: `estado`, at most about 2**precision bytes."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(column, precision).alias("estado"))


def distinct_rollup(states: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values of coarser groups from the states, `distintos`: 1 % off or less, two times in three."""
    return states.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("estado")).alias("distintos"))


def bounds(rows: DataFrame, table: str, column: str) -> DataFrame:
    return rows.agg(F.min(column).alias("minimo"), F.max(column).alias("maximo")).select(
        F.lit(table).alias("tabla"), F.lit(column).alias("columna"), "minimo", "maximo"
    )


def describe(rows: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of a numeric column, one row each.

    Quartiles are exact. For quick looks at the whole fact approx_quartiles is cheaper.
    """
    figures = exact_quantiles(rows, column, [0.25, 0.5, 0.75], [])
    named = {
        "count": F.col("n").cast("double"), "mean": F.col("media"), "std": F.col("desviacion"),
        "min": F.col("minimo"), "25%": F.col("cuantiles")[0], "50%": F.col("cuantiles")[1],
        "75%": F.col("cuantiles")[2], "max": F.col("maximo"),
    }
    lines = [F.struct(F.lit(k).alias("estadistico"), v.alias("valor")) for k, v in named.items()]
    return figures.select(F.inline(F.array(*lines)))


def approx_quartiles(rows: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """Quartiles from one mergeable sketch; rank error at most 1/accuracy of the rows."""
    return rows.agg(F.percentile_approx(column, [0.25, 0.5, 0.75], accuracy).alias("q")).select(
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75")
    )


def keyed_sample(rows: DataFrame, keys: list[str], fraction: float) -> DataFrame:
    """The rows whose keys' md5 falls below the fraction: the same rows whatever the files and
    tasks, and whatever the seed of a session. Null keys are the empty text."""
    text = F.concat_ws("-", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    drawn = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return rows.filter(drawn < F.lit(int(fraction * 2**32)))


def _edges(rows: DataFrame, *columns: str) -> list[tuple[Column, Column]]:
    """Smallest and largest value per column, all from one scalar subquery."""
    ends = [f(c).alias(f"{side}{i}") for i, c in enumerate(columns) for f, side in ((F.min, "a"), (F.max, "b"))]
    found = rows.agg(*ends).select(F.struct("*")).scalar()
    return [(found[f"a{i}"], found[f"b{i}"]) for i in range(len(columns))]


def histogram(rows: DataFrame, column: str, bins: int) -> DataFrame:
    """All equal-width bins between the smallest and largest value, empty ones with 0. Without
    any number there are no bins; if all are equal there is one."""
    numbers = rows.filter(measures.is_number(F.col(column))).select(column)
    [(low, high)] = _edges(numbers, column)
    placed = numbers.select(measures.bin_index(F.col(column), low, high, bins).alias("bin"))
    counts = placed.groupBy("bin").agg(F.count("*").alias("cantidad"))
    last = F.max("bin")
    whole = counts.agg(F.when(last == 0, F.array(F.lit(0))).when(last > 0, F.sequence(F.lit(0), F.lit(bins - 1))).alias("_b"))
    every = whole.select(F.explode("_b").alias("bin")).join(F.broadcast(counts), "bin", "left")  # at most `bins` rows
    return every.select("bin", (low + F.col("bin") * ((high - low) / bins)).alias("desde"), F.coalesce("cantidad", F.lit(0)).alias("cantidad"))


def density(rows: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Non-empty cells of a bins-by-bins grid over both value ranges."""
    numbers = rows.filter(measures.is_number(F.col(x)) & measures.is_number(F.col(y))).select(x, y)
    ends = _edges(numbers, x, y)
    cells = [
        measures.bin_index(F.col(c), low, high, bins).alias(name)
        for c, name, (low, high) in zip((x, y), ("bin_x", "bin_y"), ends)
    ]
    return numbers.select(*cells).groupBy("bin_x", "bin_y").agg(F.count("*").alias("cantidad"))


def box(rows: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Box-plot figures per group: quartiles, whiskers at the outermost values within 1.5
    interquartile ranges of the box, and the number of values beyond them."""
    numbers = rows.filter(measures.is_number(F.col(column))).select(*by, column)
    named = [F.col("cuantiles")[i].alias(q) for i, q in enumerate(("q1", "mediana", "q3"))]
    quartile = exact_quantiles(numbers, column, [0.25, 0.5, 0.75], by).select(*by, F.col("n").alias("cantidad"), *named)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    limits = quartile.select(*by, (F.col("q1") - reach).alias("_lo"), (F.col("q3") + reach).alias("_hi"))
    inside = F.col(column).between(F.col("_lo"), F.col("_hi"))
    ends = attach(numbers, limits, by).groupBy(*by).agg(
        F.min(F.when(inside, F.col(column))).alias("bigote_inferior"),
        F.max(F.when(inside, F.col(column))).alias("bigote_superior"),
        F.count_if(~inside).alias("atipicos"),
    )
    joined = quartile.join(ends, by) if by else attach(quartile, ends, by)
    return joined.select(*by, "cantidad", "q1", "mediana", "q3", "bigote_inferior", "bigote_superior", "atipicos")
