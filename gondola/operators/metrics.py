"""The price metrics, at name grain (producto) and at id grain (producto_id).

Functions taking `prices` expect the output of cube.by_name_month, by_product_month or
by_product_day, so one aggregate serves average, extremes, dispersion and variation.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from gondola.functions import calendar, measures
from gondola.operators import cube
from gondola.operators.facts import Mart

NAME_KEYS = ("producto", "anio", "mes")
ID_KEYS = ("producto_id", "producto_nombre", "anio", "mes")


def average_by_name(prices: DataFrame) -> DataFrame:
    return prices.select(*NAME_KEYS, "precio_promedio")


def average_by_product(prices: DataFrame) -> DataFrame:
    return prices.select(*ID_KEYS, "precio_promedio", "num_observaciones")


def min_max(prices: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return prices.select(*keys, "precio_minimo", "precio_maximo", "precio_promedio")


def dispersion(prices: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Price range of the period relative to its average price."""
    index = measures.dispersion(F.col("precio_minimo"), F.col("precio_maximo"), F.col("precio_promedio"))
    return min_max(prices, keys).withColumn("indice_dispersion", index)


def with_previous(rows: DataFrame, series: str, order: list[str], value: str, name: str) -> DataFrame:
    """The value of the previous row present in the series, not of the previous calendar
    period. A series has at most one row per period, which bounds its window."""
    return rows.withColumn(name, F.lag(value).over(Window.partitionBy(series).orderBy(*order)))


def carried(rows: DataFrame, series: str, order: list[str], value: str) -> DataFrame:
    """The last row of each series: all that the changes of later periods need of the past."""
    return rows.groupBy(series).agg(F.max(F.struct(*order, value)).alias("_u")).select(series, "_u.*")


def with_carried(rows: DataFrame, past: DataFrame, series: str, order: list[str], value: str, name: str) -> DataFrame:
    """with_previous of the rows of new periods, all later than what `past` (from `carried`) stands
    for; equal to it over the whole history, of which nothing else is read. A series that only the
    past has gives no row; its state stays in past."""
    known = past.select(series, F.struct(*order).alias("_o"), value, F.lit(True).alias("_v"))
    new = rows.withColumns({"_o": F.struct(*order), "_v": F.lit(False)})
    whole = new.unionByName(known, allowMissingColumns=True)
    before = F.lag(value).over(Window.partitionBy(series).orderBy("_o"))
    return whole.withColumn(name, before).filter("NOT _v").drop("_o", "_v")


def advance(past: DataFrame, rows: DataFrame, series: str, order: list[str], value: str) -> DataFrame:
    """The carried rows after the new periods: the two merge like any last rows."""
    columns = [series, *order, value]
    return carried(past.select(columns).unionByName(rows.select(columns)), series, order, value)


def variation_by_name(prices: DataFrame) -> DataFrame:
    """Monthly change per product name; the first month of a series has none."""
    months = prices.select(*NAME_KEYS, F.col("precio_promedio").alias("precio_mes"))
    change = measures.pct_change(F.col("precio_mes"), F.col("precio_anterior"))
    return (
        with_previous(months, "producto", ["anio", "mes"], "precio_mes", "precio_anterior")
        .withColumn("variacion_pct", change)
        .filter("variacion_pct IS NOT NULL")
    )


def months_after(prices: DataFrame, months: list[tuple[int, int]]) -> set[tuple[int, int]]:
    """The (year, month) pairs, `months` aside, in which a product's row may follow one of `months`,
    present or gone: for each of these, the first month a product has after it. Any row between
    would be the first itself, so these are all rows whose previous price can be another now."""
    number = F.col("anio") * 12 + F.col("mes")
    changed = sorted(y * 12 + m for y, m in months)
    if not changed:
        return set()
    later = [F.min(F.when((number > c) & ~number.isin(changed), number)).alias(f"_{k}") for k, c in enumerate(changed)]
    firsts = prices.groupBy("producto").agg(*later)
    found = firsts.select(F.explode(F.array(*[f"_{k}" for k in range(len(changed))])).alias("n")).filter("n IS NOT NULL").distinct()
    return {((r.n - 1) // 12, (r.n - 1) % 12 + 1) for r in found.collect()}  # months, not rows


def combined_by_name(prices: DataFrame) -> DataFrame:
    """Average, extremes, dispersion and monthly change side by side, from one aggregate
    and one window. The change is null in the first month of a series."""
    change = measures.pct_change(F.col("precio_promedio"), F.col("precio_anterior"))
    spread = dispersion(prices, NAME_KEYS)
    return with_previous(
        spread, "producto", ["anio", "mes"], "precio_promedio", "precio_anterior"
    ).withColumn("variacion_pct", change)


def variation_by_product(prices: DataFrame) -> DataFrame:
    """Monthly change per product id."""
    months = prices.select(
        "producto_id",
        "producto_nombre",
        "anio",
        "mes",
        calendar.period_label(F.col("anio"), F.col("mes")).alias("anio_mes"),
        F.col("precio_promedio").alias("precio_promedio_mes"),
    )
    change = measures.pct_change(F.col("precio_promedio_mes"), F.col("anterior"))
    return (
        with_previous(months, "producto_id", ["anio", "mes"], "precio_promedio_mes", "anterior")
        .withColumn("variacion_mensual_pct", change)
        .filter("variacion_mensual_pct IS NOT NULL")
        .drop("anterior")
    )


def variation_daily(prices: DataFrame) -> DataFrame:
    """Daily change per product id."""
    days = prices.select("producto_id", "producto_nombre", "fecha", "precio_promedio")
    change = measures.pct_change(F.col("precio_promedio"), F.col("anterior"))
    return (
        with_previous(days, "producto_id", ["fecha"], "precio_promedio", "anterior")
        .withColumn("variacion_diaria_pct", change)
        .filter("variacion_diaria_pct IS NOT NULL")
        .drop("anterior")
    )


def price_extremes(mart: Mart, monthly: DataFrame | None = None) -> DataFrame:
    """Monthly extremes per product id with the store that had them.

    Among stores sharing an extreme price the smallest name is given, a missing name only
    when all of them lack one. A state that knows its store's name merges with others like the
    sums do: of two, the lower price with its name stays, and the higher one. So one
    aggregation of the states gives figures and names, without going back to the states.
    """
    monthly = cube.monthly_cube(mart) if monthly is None else monthly
    keys = ["producto_id", "anio", "mes"]
    named = monthly.join(mart.stores.side(F.col("nombre").alias("local")), "establecimiento_id")
    at = lambda price: F.min(F.struct(price.alias("precio"), F.col("local").isNull().alias("falta"), "local"))
    extremes = named.groupBy(*keys).agg(
        F.sum("n").alias("n"), measures.total(F.col("total")).alias("total"),
        at(F.col("bajo")).alias("barato"), at(-F.col("alto")).alias("caro"),
    )
    return extremes.join(
        mart.products.side(F.col("nombre").alias("producto_nombre")), "producto_id"
    ).select(
        *ID_KEYS,
        F.col("barato.precio").alias("precio_minimo"),
        F.col("barato.local").alias("establecimiento_mas_barato"),
        (-F.col("caro.precio")).alias("precio_maximo"),
        F.col("caro.local").alias("establecimiento_mas_caro"),
        (measures.money(F.col("total"), mart.price_scale) / F.col("n")).alias("precio_promedio"),
    )


def by_category_chain_month(mart: Mart) -> DataFrame:
    """Average, count and extremes per month, category and chain."""
    states = cube.attach(
        cube.observations(mart), mart.products, ["anio", "mes", "establecimiento_id"], categoria="categoria"
    )
    states = cube.attach(
        states, mart.stores, ["anio", "mes", "categoria"], cadena_normalizada="cadena_normalizada"
    )
    keys = ("anio", "mes", "categoria", "cadena_normalizada")
    prices = cube.priced(cube.roll_up(states, *keys), mart.price_scale, *keys)
    return prices.select(
        *keys,
        "precio_promedio",
        F.col("num_observaciones").alias("cantidad_observaciones"),
        F.col("precio_minimo").alias("precio_min"),
        F.col("precio_maximo").alias("precio_max"),
    )


def by_region_category_month(mart: Mart, first_year: int) -> DataFrame:
    """Average and count per region, category and calendar month from first_year on; the
    years are pooled. The year limit is put on the date and on a stored year, where it prunes
    row groups and partitions."""
    january = F.make_date(F.lit(first_year), F.lit(1), F.lit(1))
    fact = mart.fact.filter(F.col("fecha") >= january)
    if "anio" in fact.columns:
        fact = fact.filter(F.col("anio") >= first_year)
    recent = replace(mart, fact=fact)
    states = cube.attach(
        cube.observations(recent), mart.products, ["mes", "establecimiento_id"], categoria="categoria"
    )
    states = cube.attach(states, mart.locations, ["mes", "categoria"], departamento="departamento")
    keys = ("departamento", "categoria", "mes")
    prices = cube.priced(cube.roll_up(states, *keys), mart.price_scale, *keys)
    return prices.select(*keys, "precio_promedio", F.col("num_observaciones").alias("total_observaciones"))
