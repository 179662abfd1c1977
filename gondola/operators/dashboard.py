"""Dashboard analytics over the metric tables. Rows without a group name are left out of
the groupings, and means over months or products are unweighted means of the metric rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gondola.functions import calendar, measures
from gondola.operators import ranking
from gondola.operators.quantiles import exact_quantiles

# Outlier windows of the charts.
VARIATION_WINDOW = (-50, 50)
DISPERSION_LIMIT = 2.0
HIGH_DISPERSION = 1.0


def period() -> Column:
    return calendar.period_start(F.col("anio"), F.col("mes"))


def trim_variation(variation: DataFrame) -> DataFrame:
    return variation.filter(F.col("variacion_pct").between(*VARIATION_WINDOW))


def trim_dispersion(dispersion: DataFrame) -> DataFrame:
    return dispersion.filter(F.col("indice_dispersion") <= DISPERSION_LIMIT)


def top_series(prices: DataFrame, column: str, value: str, k: int) -> DataFrame:
    """Dated series of the k groups with most rows."""
    return ranking.in_top_groups(prices, column, k).select(period().alias("fecha"), column, value)


def group_stats(rows: DataFrame, column: str, value: str) -> DataFrame:
    """Mean, exact median, extremes and sample deviation of value per group."""
    return exact_quantiles(rows, value, [0.5], [column]).select(
        column, F.col("media").alias("mean"), F.col("cuantiles")[0].alias("median"),
        F.col("minimo").alias("min"), F.col("maximo").alias("max"), F.col("desviacion").alias("std"),
    )


def display_rounded(rows: DataFrame, digits: int = 2) -> DataFrame:
    """Half-even rounding of all double columns, for presentation only."""
    return rows.select(
        *[F.bround(c, digits).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes]
    )


def monthly_overview(combined: DataFrame, basket: DataFrame, price_scale: int | None = None) -> DataFrame:
    """One row per month with the mean of each metric, from combined product rows and basket
    costs; a month absent from one of them (the first has no variation) is null there."""
    of_products = combined.groupBy("anio", "mes").agg(
        *[F.avg(c).alias(c) for c in ("precio_promedio", "variacion_pct", "indice_dispersion")]
    )
    of_baskets = basket.groupBy("anio", "mes").agg(
        measures.mean(F.col("costo_canasta"), price_scale).alias("costo_canasta")
    )
    both = of_products.join(of_baskets, ["anio", "mes"], "full")
    return both.select(
        "anio", "mes", period().alias("fecha"),
        "precio_promedio", "variacion_pct", "indice_dispersion", "costo_canasta",
    )


def trend(overview: DataFrame) -> DataFrame:
    """Overall mean of each monthly metric and whether its last month lies above its first
    (an unchanged value counts as falling)."""
    names = ("precio_promedio", "variacion_pct", "indice_dispersion", "costo_canasta")
    figures = []
    for v in names:
        when = F.when(F.col(v).isNotNull(), F.col("fecha"))
        figures.append(F.avg(v).alias(f"m_{v}"))
        figures.append((F.max_by(v, when) > F.min_by(v, when)).alias(f"s_{v}"))
    lines = [
        F.struct(
            F.lit(v).alias("metrica"), F.col(f"m_{v}").alias("promedio"),
            F.when(F.col(f"s_{v}"), "↑").otherwise("↓").alias("tendencia"),
        )
        for v in names
    ]
    return overview.agg(*figures).select(F.inline(F.array(*lines)))


def leaders(
    rows: DataFrame, value: str, statistic: Callable, k: int = 5, descending: bool = True
) -> DataFrame:
    """The k products with the highest (or lowest) statistic over their rows."""
    scores = (
        rows.filter(F.col("producto").isNotNull())
        .groupBy("producto")
        .agg(statistic(value).alias("valor"))
        .filter(measures.is_number(F.col("valor")))
    )
    order = F.desc("valor") if descending else F.asc("valor")
    return ranking.top(scores, k, order, "producto")


def extreme_rows(rows: DataFrame, value: str, k: int, descending: bool) -> DataFrame:
    """The k rows with the highest (or lowest) value."""
    order = F.desc(value) if descending else F.asc(value)
    return ranking.top(rows.filter(measures.is_number(F.col(value))), k, order, "producto", "anio", "mes")


def price_ranges(prices: DataFrame, k: int) -> DataFrame:
    """The k widest price ranges, with the axis label of their bar."""
    ranges = prices.select(
        "producto", "anio", "mes", "precio_minimo", "precio_maximo",
        (F.col("precio_maximo") - F.col("precio_minimo")).alias("rango_precio"),
    )
    label = F.concat(
        F.substring("producto", 1, 20), F.lit("... "), calendar.period_label(F.col("anio"), F.col("mes"))
    )
    return extreme_rows(ranges, "rango_precio", k, True).withColumn("etiqueta", label)


def latest(rows: DataFrame) -> DataFrame:
    """Rows of the last month present."""
    months = F.col("anio") * 12 + F.col("mes")
    return rows.filter(months == rows.agg(F.max(months)).scalar())


def cheapest_latest(ranked: DataFrame, k: int) -> DataFrame:
    return ranking.top(latest(ranked), k, "ranking").select("ranking", "supermercado", "costo_canasta")


def dearest_latest(ranked: DataFrame, k: int) -> DataFrame:
    """The dearest stores of the whole last month, not the tail of a cheap selection."""
    return ranking.top(latest(ranked), k, F.desc("ranking")).select("ranking", "supermercado", "costo_canasta")


def integrate(dispersion: DataFrame, variation: DataFrame) -> DataFrame:
    """Dispersion and variation of the same product and month, from two stored tables."""
    return dispersion.join(
        variation.select("producto", "anio", "mes", "variacion_pct"), ["producto", "anio", "mes"]
    )


def integrated(combined: DataFrame) -> DataFrame:
    """The same rows as integrate, read off the combined metrics without a join."""
    return combined.filter("variacion_pct IS NOT NULL AND producto IS NOT NULL").drop("precio_anterior")


def trim_integrated(integrated: DataFrame) -> DataFrame:
    return trim_variation(integrated).filter(F.col("indice_dispersion") < DISPERSION_LIMIT)


def correlation(integrated: DataFrame) -> DataFrame:
    """Pearson matrix in long form, each pair over the rows where both are present."""
    names = ("indice_dispersion", "variacion_pct", "precio_promedio")
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    figures = integrated.agg(*[F.corr(a, b).alias(f"{a}_{b}") for a, b in pairs])
    cells = [(a, a, F.lit(1.0)) for a in names]
    for a, b in pairs:
        cells += [(a, b, F.col(f"{a}_{b}")), (b, a, F.col(f"{a}_{b}"))]
    lines = [
        F.struct(F.lit(a).alias("fila"), F.lit(b).alias("columna"), v.alias("correlacion")) for a, b, v in cells
    ]
    return figures.select(F.inline(F.array(*lines)))


def dispersion_bands(dispersion: DataFrame) -> DataFrame:
    banded = dispersion.select(measures.dispersion_band(F.col("indice_dispersion")).alias("banda"))
    return banded.groupBy("banda").agg(F.count("*").alias("cantidad"))


def executive_summary(combined: DataFrame, basket: DataFrame) -> DataFrame:
    """The headline figures of all metrics as one row. The cheapest and dearest store are
    those of the last month."""
    median = exact_quantiles(combined, "indice_dispersion", [0.5], [])
    of_products = combined.agg(
        F.count_distinct("producto").alias("productos_analizados"),
        F.avg("precio_promedio").alias("precio_promedio_general"),
        F.min("precio_promedio").alias("precio_minimo"),
        F.max("precio_promedio").alias("precio_maximo"),
        F.avg("variacion_pct").alias("variacion_promedio"),
        F.max("variacion_pct").alias("mayor_aumento"),
        F.min("variacion_pct").alias("mayor_caida"),
        F.avg("indice_dispersion").alias("dispersion_promedio"),
        F.count_if(F.col("indice_dispersion") > HIGH_DISPERSION).alias("registros_alta_dispersion"),
    )
    named = basket.filter(F.col("supermercado").isNotNull())
    month = F.col("anio") * 12 + F.col("mes")
    of_baskets = named.agg(
        F.count_distinct("supermercado").alias("supermercados_analizados"),
        F.avg("costo_canasta").alias("costo_promedio"),
        F.min("costo_canasta").alias("costo_minimo"),
        F.max("costo_canasta").alias("costo_maximo"),
        F.min(F.struct(-month, "costo_canasta", "supermercado")).alias("barato"),
        F.max(F.struct(month, "costo_canasta", "supermercado")).alias("caro"),
    )
    cheap, dear = F.col("b.barato.costo_canasta"), F.col("b.caro.costo_canasta")
    return of_products.select(
        "*",
        median.select(F.col("cuantiles")[0]).scalar().alias("dispersion_mediana"),
        of_baskets.select(F.struct("*")).scalar().alias("b"),
    ).select(
        *of_products.columns,
        "dispersion_mediana",
        "b.supermercados_analizados",
        "b.costo_promedio",
        "b.costo_minimo",
        "b.costo_maximo",
        (F.col("b.costo_maximo") - F.col("b.costo_minimo")).alias("costo_diferencia"),
        F.col("b.barato.supermercado").alias("mas_economico"),
        F.col("b.caro.supermercado").alias("mas_caro"),
        (dear - cheap).alias("diferencia_precio"),
        ((dear / cheap - 1) * 100).alias("diferencia_pct"),
    )
