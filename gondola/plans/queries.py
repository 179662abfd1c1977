"""Registered queries: every operator over the star-schema test tables.

Each takes (spark, folder). Averages of averages, deviations and other values whose last
bits depend on summation order are rounded here, and only here, so that another engine's
result can be compared with them; figures built on whole-unit sums are left as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.functions import measures, parsing
from gondola.operators import (
    basket, cleaning, cube, dashboard, dimensions, facts, metrics, ownership, profile, quality, quantiles, ranking, scale, skew,
)
from gondola.operators.facts import Mart
from gondola.plans import jobs, tables
from gondola.sources import csvfiles
from gondola.sources.lake import Lake

# Parameters that make the operators bite on the test tables.
BASKET = (
    "blue anvil", "blue bolt", "blue gizmo", "blue ring", "blue rod",
    "blue widget", "cold anvil", "cold bolt", "cold gear", "cold gizmo",
)
BASKET_CATEGORIES = ("ECONOMY", "PROMO")
FIRST_YEAR = 1998
CHECKS = (
    *quality.STAR_CHECKS,
    quality.InRange("dim_tiempo", "anio", 1995, 2001),
    quality.Unique("lineas", ("l_orderkey", "l_linenumber")),
    quality.ForeignKey("lineas", "l_partkey", "dim_establecimiento", "establecimiento_id"),
    quality.ForeignKey("fact_precios", "fecha_id", "calendario", "fecha_id"),
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def rounded(rows: DataFrame, digits: int, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(F.col(c), digits) for c in columns})


def on_mart(name: str, build: Callable[[Mart], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, folder: build(tables.mart(spark, folder))


def names(mart: Mart) -> DataFrame:
    return cube.by_name_month(mart)


def variation(mart: Mart) -> DataFrame:
    return metrics.variation_by_name(names(mart))


def dispersion(mart: Mart) -> DataFrame:
    return metrics.dispersion(names(mart), metrics.NAME_KEYS)


def costs(mart: Mart) -> DataFrame:
    return basket.cost_by_observation(mart, BASKET)


def ranked(mart: Mart) -> DataFrame:
    """The ranking of kept costs, as the batch job ranks its stored ones."""
    return basket.rank_by_observation(scale.cut(costs(mart)))


def combined(mart: Mart) -> DataFrame:
    return metrics.combined_by_name(names(mart))


def integrated(mart: Mart) -> DataFrame:
    return dashboard.integrated(combined(mart))


# --- sources and cleaning ---------------------------------------------------------------


def price_text(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as the text of a price file, with the defects the cleaning must handle:
    by quantity, prices that are empty, no number, zero, negative or NaN; by line number,
    dates in another format, ids written as 12.0, missing ids and bad offer flags."""
    quantity, line = F.col("l_quantity"), F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("string")
    for value, text in {1: None, 2: "abc", 3: "0", 4: "-5", 5: "NaN"}.items():
        price = F.when(quantity == value, F.lit(text)).otherwise(price)
    day, product = F.col("l_shipdate").cast("date"), F.col("l_partkey").cast("string")
    year = F.year(day)
    return tables.table(spark, folder, "lineitem").select(
        F.when(line == 2, F.date_format(day, "dd/MM/yyyy")).otherwise(day.cast("string")).alias("Fecha"),
        price.alias("Precio"),
        F.when(line == 3, F.concat(product, F.lit(".0"))).when(quantity != 6, product).alias("Presentacion_Producto"),
        F.col("l_suppkey").cast("string").alias("Establecimiento"),
        F.when(line == 4, "x").when(F.col("l_discount") > 0, "1").otherwise("0").alias("Oferta"),
        F.format_string(
            "/lake/landing/%d/precios_%d.csv", year, F.when(line == 7, year + 1).otherwise(year)
        ).alias("ruta"),
    )


def product_text(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as catalogue rows, each listed in two sizes."""
    sizes = F.array(F.col("p_size"), F.col("p_size") + 1)
    listed = tables.table(spark, folder, "part").withColumn("talla", F.explode(sizes))
    return listed.select(
        F.col("p_partkey").cast("string").alias("id.producto"),
        F.col("p_type").alias("producto"),
        F.col("p_brand").alias("marca"),
        F.format_string("size %02d", "talla").alias("especificacion"),
        F.col("p_name").alias("nombre"),
    )


def store_text(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as catalogue rows, each listed with and without a chain."""
    places = tables.dim_location(spark, folder)
    stores = tables.dim_store(spark, folder)
    return stores.join(places, "establecimiento_id").select(
        F.col("establecimiento_id").cast("string").alias("id.establecimientos"),
        F.col("razon_social").alias("razon.social"),
        F.col("nombre").alias("nombre.sucursal"),
        "direccion",
        "ciudad",
        F.col("departamento").alias("depto"),
        F.explode(F.array(F.col("cadena_normalizada"), F.lit(None))).alias("cadena"),
        "barrio",
    )


@query
def raw_prices(spark, folder):
    return cleaning.clean_prices(price_text(spark, folder))


@query
def raw_products(spark, folder):
    return cleaning.clean_products(product_text(spark, folder))


@query
def raw_stores(spark, folder):
    return cleaning.clean_stores(store_text(spark, folder))


@query
def multi_year_prices(spark, folder):
    """Valid observations per yearly file, read back from files: a folder a year in the shared
    folder, of which even years have their columns in another order. Line number 7 stands in a
    file that is named after another year than its folder."""
    text = scale.cut(price_text(spark, folder))
    landing = f"{scale.shared_folder(spark)}/anual-{uuid.uuid4().hex}"
    columns = list(csvfiles.PRICES.required)

    def write(path: str) -> None:
        year = int(path.split("/")[-2])
        rows = text.filter(F.col("ruta") == path).select(columns[::-1] if year % 2 == 0 else columns)
        name = "/".join(path.split("/")[-2:])
        rows.write.options(**csvfiles.PRICES.options, header="true", emptyValue="").csv(f"{landing}/{name}")

    paths = [r.ruta for r in text.select("ruta").distinct().collect()]  # two a year
    jobs.together(*[partial(write, path) for path in paths])
    yearly = csvfiles.read_yearly_prices(spark, landing)
    valid = yearly.filter(parsing.as_price(F.col("Precio")) > 0)
    return valid.groupBy("anio_archivo").agg(F.count("*").alias("filas"))


@query
def source_contract(spark, folder):
    """Prices and products meet their contract; the store file lacks a column."""
    return csvfiles.contract(
        {
            csvfiles.PRICES: price_text(spark, folder),
            csvfiles.PRODUCTS: product_text(spark, folder),
            csvfiles.STORES: store_text(spark, folder).drop("barrio"),
        },
        spark,
    )


@query
def ingest_audit(spark, folder):
    text = {
        "precios": price_text(spark, folder),
        "productos": product_text(spark, folder),
        "establecimientos": store_text(spark, folder),
    }
    kept = {
        "precios": cleaning.clean_prices(text["precios"]),
        "productos": cleaning.clean_products(text["productos"]),
        "establecimientos": cleaning.clean_stores(text["establecimientos"]),
    }
    return csvfiles.audit(text, kept)


# --- model ------------------------------------------------------------------------------


@query
def dim_time(spark, folder):
    return tables.dim_time(spark, folder)


@query
def dim_product(spark, folder):
    """From the cleaned catalogue, whose rows come in two sizes each."""
    return dimensions.dim_product(cleaning.clean_products(product_text(spark, folder)))


@query
def dim_store(spark, folder):
    return dimensions.dim_store(cleaning.clean_stores(store_text(spark, folder)))


@query
def dim_location(spark, folder):
    return dimensions.dim_location(cleaning.clean_stores(store_text(spark, folder)))


@query
def fact_prices(spark, folder):
    """From raw rows with text ids, of which line number 3 writes products like 12.0 and
    line number 2 lacks the date."""
    raw = tables.table(spark, folder, "lineitem").selectExpr(
        "IF(l_linenumber = 2, NULL, CAST(l_shipdate AS DATE)) AS fecha",
        "concat(l_partkey, IF(l_linenumber = 3, '.0', '')) AS producto_id",
        "CAST(l_suppkey AS STRING) AS establecimiento_id",
        "l_extendedprice AS precio",
        "IF(l_discount > 0, 1, 0) AS oferta",
    )
    mart = tables.mart(spark, folder)
    return facts.fact_prices(raw, mart.products, mart.stores, mart.locations)


@query
def fact_partitions(spark, folder):
    """Rows per day of a fact written by month, after its months from FIRST_YEAR on were
    replaced: their first writing had these observations forty years later."""
    lake = Lake(spark, f"{scale.shared_folder(spark)}/lago-{uuid.uuid4().hex}")
    fact = tables.fact(spark, folder)
    recent = F.year("fecha") >= FIRST_YEAR
    wrong = F.when(recent, F.add_months("fecha", 480)).otherwise(F.col("fecha"))

    def write(rows, within=None):
        dated = rows.withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})
        return lake.replace_partitions("refined", "fact_precios", dated, jobs.MONTH, ("fecha",), within=within)

    write(fact.withColumn("fecha", wrong))
    right = write(fact.filter(recent), lambda p: int(p["anio"]) >= FIRST_YEAR)
    return right.groupBy("fecha").agg(F.count("*").alias("filas"))


@query
def arrivals_current(spark, folder):
    """Observations that count when line numbers 1 to 5 are a load, written on day 3, and the lines
    2 to 7 came as daily files written on day `line number mod 7`: per line number and source
    the rows that are left."""
    line = tables.table(spark, folder, "lineitem").selectExpr(
        "CAST(l_shipdate AS DATE) AS fecha", "CAST(l_partkey AS STRING) AS producto_id", "CAST(l_suppkey % 50 AS STRING) AS establecimiento_id",
        "l_extendedprice AS precio", "l_linenumber AS oferta",
    )
    on = lambda day: F.timestamp_add("DAY", day, F.lit("2025-01-01").cast("timestamp"))
    loaded = line.filter("oferta <= 5").withColumn(ownership.WRITTEN, on(F.lit(3)))
    arrived = line.filter("oferta >= 2").withColumns({
        ownership.WRITTEN: on(F.col("oferta") % 7), ownership.FILE: F.concat(F.lit("d"), F.col("oferta").cast("string")), "oferta": F.col("oferta") + 100,
    })
    return ownership.current(loaded, arrived).groupBy("oferta").agg(F.count("*").alias("filas"), F.min("precio").alias("minimo"))


@query
def cube_incremental(spark, folder):
    """Monthly figures from a cube that was built without the observations of every third supplier
    in two years and then had those years' months replaced."""
    lake = Lake(spark, f"{scale.shared_folder(spark)}/lago-{uuid.uuid4().hex}")
    mart = tables.mart(spark, folder)
    dated = F.year("fecha").isin(FIRST_YEAR - 2, FIRST_YEAR)
    months = [(y, m) for y in (FIRST_YEAR - 2, FIRST_YEAR) for m in range(1, 13)]
    early = replace(mart, fact=mart.fact.filter(~dated | (F.col("establecimiento_id") % 3 != 0)))
    late = replace(mart, fact=mart.fact.filter(dated))
    lake.replace_partitions("refined", jobs.CUBE, cube.monthly_cube(early), jobs.MONTH)
    merged = lake.replace_partitions("refined", jobs.CUBE, cube.monthly_cube(late), jobs.MONTH, within=jobs.named_months(months))
    return cube.priced(cube.roll_up(merged, "anio", "mes"), mart.price_scale, "anio", "mes")


def model(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "fact_precios": tables.fact(spark, folder),
        "dim_tiempo": tables.dim_time(spark, folder),
        "dim_producto": tables.dim_product(spark, folder),
        "dim_establecimiento": tables.dim_store(spark, folder),
        "dim_ubicacion": tables.dim_location(spark, folder),
    }


# --- metrics ----------------------------------------------------------------------------

on_mart("avg_price_by_name_month", lambda m: metrics.average_by_name(names(m)))
on_mart("avg_price_by_product_month", lambda m: metrics.average_by_product(cube.by_product_month(m)))
on_mart("min_max_by_name_month", lambda m: metrics.min_max(names(m), metrics.NAME_KEYS))
on_mart("min_max_by_product_month", lambda m: metrics.min_max(cube.by_product_month(m), metrics.ID_KEYS))
on_mart("dispersion_by_name_month", dispersion)
on_mart("dispersion_by_product_month", lambda m: metrics.dispersion(cube.by_product_month(m), metrics.ID_KEYS))
on_mart("variation_monthly_by_name", variation)
on_mart("variation_monthly_by_product", lambda m: metrics.variation_by_product(cube.by_product_month(m)))
on_mart("variation_daily", lambda m: metrics.variation_daily(cube.by_product_day(m)))
on_mart("price_extremes_with_store", metrics.price_extremes)
on_mart("star_category_chain_month", metrics.by_category_chain_month)
on_mart("star_region_category_month", lambda m: metrics.by_region_category_month(m, FIRST_YEAR))
on_mart("basket_cost_sum", costs)
on_mart("basket_cost_variation", lambda m: basket.cost_variation(costs(m)))
on_mart("store_ranking_sum", ranked)


@query
def variation_daily_carried(spark, folder):
    """Daily changes from FIRST_YEAR on, of which only each product's last earlier day is known."""
    prices = scale.cut(cube.by_product_day(tables.mart(spark, folder)).select("producto_id", "producto_nombre", "fecha", "precio_promedio"))
    new = F.year("fecha") >= FIRST_YEAR
    of = ("producto_id", ["fecha"], "precio_promedio")
    past = metrics.advance(metrics.carried(prices.filter(F.year("fecha") < FIRST_YEAR - 1), *of), prices.filter(F.year("fecha") == FIRST_YEAR - 1), *of)
    found = metrics.with_carried(prices.filter(new), past, *of, "anterior")
    change = measures.pct_change(F.col("precio_promedio"), F.col("anterior"))
    return found.withColumn("variacion_diaria_pct", change).filter("variacion_diaria_pct IS NOT NULL").drop("anterior")


@query
def distinct_products_rollup(spark, folder):
    """Products priced per year: exact, and whether what is rolled up from states by region is within 4 %."""
    mart = tables.mart(spark, folder)
    priced = cube.attach(cube.observations(mart), mart.locations, ["anio", "producto_id"], departamento="departamento")
    states = profile.distinct_states(priced, ["anio", "departamento"], "producto_id")
    about = profile.distinct_rollup(states, ["anio"])
    exact = priced.groupBy("anio").agg(F.count_distinct("producto_id").alias("productos"))
    near = F.abs(F.col("distintos") - F.col("productos")) <= 0.04 * F.col("productos")
    return exact.join(about, "anio").select("anio", "productos", near.alias("cerca"))


@query
def fact_prices_salted(spark, folder):
    """Rows and units per product of a fact of which one product has a third, joined by a shuffle
    with hot keys split."""
    prices = tables.prices(spark, folder)
    hot = prices.withColumn("producto_id", F.when(F.dayofmonth("fecha") <= 10, F.lit(1)).otherwise(F.col("producto_id")))
    found = skew.join(hot, tables.dim_product(spark, folder).select("producto_id", "marca"), "producto_id")
    return found.groupBy("producto_id", "marca").agg(F.count("*").alias("filas"), F.max("precio").alias("precio_maximo"))


@query
def basket_cost_avg(spark, folder):
    found = basket.cost_by_average(tables.mart(spark, folder), BASKET, "nombre")
    return rounded(found, 6, "costo_total_canasta")


@query
def basket_cost_avg_category(spark, folder):
    """The basket by category, the operator's default column."""
    found = basket.cost_by_average(tables.mart(spark, folder), BASKET_CATEGORIES)
    return rounded(found, 6, "costo_total_canasta")


@query
def store_ranking_avg(spark, folder):
    mart = tables.mart(spark, folder)
    found = scale.cut(basket.cost_by_average(mart, BASKET, "nombre"))
    return rounded(basket.rank_by_average(found), 6, "costo_total_canasta")


# --- quality ----------------------------------------------------------------------------


def check_results(spark: SparkSession, folder: str, kind: type | None = None) -> DataFrame:
    rows = {**model(spark, folder), "lineas": tables.table(spark, folder, "lineitem")}
    rows["calendario"] = rows["dim_tiempo"].filter(F.col("anio") < FIRST_YEAR)
    return quality.evaluate(rows, [c for c in CHECKS if kind is None or isinstance(c, kind)])


for _name, _kind in {
    "dq_nulls": quality.NotNull,
    "dq_fk": quality.ForeignKey,
    "dq_duplicates": quality.Unique,
    "dq_range": quality.InRange,
    "dq_domain": quality.InDomain,
}.items():
    REGISTRY[_name] = lambda spark, folder, kind=_kind: check_results(spark, folder, kind)


@query
def dq_report(spark, folder):
    """The star-schema checks alone, one row each."""
    return quality.report(quality.evaluate(model(spark, folder), quality.STAR_CHECKS))


@query
def dq_summary(spark, folder):
    return quality.summary(dq_report(spark, folder))


def raw_zone(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "precios": raw_prices(spark, folder),
        "productos": raw_products(spark, folder),
        "establecimientos": raw_stores(spark, folder),
    }


@query
def null_profile(spark, folder):
    zone = raw_zone(spark, folder)
    return reduce(DataFrame.unionAll, [quality.null_profile(rows, name) for name, rows in zone.items()])


@query
def dup_rows(spark, folder):
    """Whole-row copies of the prices, key copies of the line items, and id copies of the
    catalogues before deduplication."""
    lines = tables.table(spark, folder, "lineitem")
    return (
        quality.duplicate_profile(raw_prices(spark, folder), "precios")
        .unionAll(quality.duplicate_profile(lines, "lineas", ("l_orderkey", "l_linenumber")))
        .unionAll(quality.duplicate_profile(product_text(spark, folder), "productos", ("id.producto",)))
        .unionAll(quality.duplicate_profile(store_text(spark, folder), "establecimientos", ("id.establecimientos",)))
    )


@query
def orphan_keys(spark, folder):
    """Ids of the raw prices that the catalogues lack as written: products like 12.0."""
    zone = raw_zone(spark, folder)
    parts = [
        quality.orphan_keys(zone["precios"], zone[catalogue], key).select(
            F.lit(catalogue).alias("catalogo"), F.col(key).alias("clave")
        )
        for catalogue, key in (("productos", "producto_id"), ("establecimientos", "establecimiento_id"))
    ]
    return parts[0].unionAll(parts[1])


# --- exploration ------------------------------------------------------------------------

on_mart("daily_price_profile", profile.daily_profile)
on_mart("price_stats_by_category", lambda m: rounded(profile.category_profile(m), 4, "desviacion_std"))
on_mart("freq_offer", lambda m: ranking.frequency(m.fact, ["oferta"]))
on_mart("freq_category", lambda m: ranking.frequency(m.products.frame, ["categoria"], 50))
on_mart("freq_subcategory", lambda m: ranking.frequency(m.products.frame, ["subcategoria"], 30))
on_mart("freq_brand", lambda m: ranking.frequency(m.products.frame, ["marca"], 20))
on_mart("freq_region", lambda m: ranking.frequency(m.locations.frame, ["departamento"], 25))
on_mart("freq_city", lambda m: ranking.frequency(m.locations.frame, ["ciudad"], 20))
on_mart("freq_chain", lambda m: ranking.frequency(m.stores.frame, ["cadena"], 15))
on_mart(
    "freq_chain_normalized",
    lambda m: ranking.frequency(m.stores.frame, ["cadena", "cadena_normalizada"], 20),
)


@query
def coverage_quarter(spark, folder):
    return ranking.frequency(tables.dim_time(spark, folder), ["anio", "trimestre"])


@query
def coverage_weekday(spark, folder):
    return ranking.frequency(tables.dim_time(spark, folder), ["dia_semana", "nombre_dia"])


@query
def coverage_date(spark, folder):
    return ranking.frequency(tables.fact(spark, folder), ["fecha_id"])


@query
def table_counts(spark, folder):
    return profile.row_counts(model(spark, folder))


@query
def schema_profile(spark, folder):
    return profile.schema_profile(model(spark, folder))


@query
def cardinality_profile(spark, folder):
    """Distinct values of the catalogues and of two metric tables, with their years."""
    mart = tables.mart(spark, folder)
    parts = [
        profile.cardinality(mart.products.frame, "dim_producto", ["categoria", "subcategoria", "marca"]),
        profile.cardinality(mart.stores.frame, "dim_establecimiento", ["cadena", "cadena_normalizada"]),
        profile.cardinality(mart.locations.frame, "dim_ubicacion", ["departamento", "ciudad", "barrio"]),
        profile.cardinality(names(mart), "precio_promedio", ["producto", "anio"]),
        profile.cardinality(costs(mart), "canasta_basica", ["supermercado", "anio"]),
    ]
    years = [
        profile.bounds(names(mart), "precio_promedio", "anio"),
        profile.bounds(costs(mart), "canasta_basica", "anio"),
    ]
    distinct, spans = reduce(DataFrame.unionAll, parts), reduce(DataFrame.unionAll, years)
    return distinct.join(spans, ["tabla", "columna"], "left")


on_mart("describe_price", lambda m: rounded(profile.describe(m.fact, "precio"), 4, "valor"))
on_mart("describe_variation", lambda m: rounded(profile.describe(variation(m), "variacion_pct"), 6, "valor"))
on_mart("describe_dispersion", lambda m: rounded(profile.describe(dispersion(m), "indice_dispersion"), 6, "valor"))
on_mart("hist_price", lambda m: profile.histogram(m.fact, "precio", 100))
on_mart(
    "hist_variation", lambda m: profile.histogram(dashboard.trim_variation(variation(m)), "variacion_pct", 50)
)
on_mart(
    "hist_dispersion",
    lambda m: profile.histogram(dashboard.trim_dispersion(dispersion(m)), "indice_dispersion", 50),
)
on_mart("box_price", lambda m: rounded(profile.box(m.fact, "precio", []), 6, "q1", "mediana", "q3"))
on_mart(
    "box_variation_year",
    lambda m: rounded(
        profile.box(dashboard.trim_variation(variation(m)), "variacion_pct", ["anio"]), 6, "q1", "mediana", "q3"
    ),
)
on_mart(
    "box_basket_store",
    lambda m: rounded(
        profile.box(ranking.in_top_groups(costs(m), "supermercado", 8), "costo_canasta", ["supermercado"]),
        6, "q1", "mediana", "q3",
    ),
)
on_mart("approx_quartiles_price", lambda m: profile.approx_quartiles(m.fact, "precio", 10_000_000))


@query
def quartiles_by_year_from_states(spark, folder):
    """Exact quartiles of each year's prices; states kept per month bracket them."""
    dated = tables.fact(spark, folder).withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})
    stored = scale.cut(quantiles.states(dated, "precio", ["anio", "mes"]))
    found = quantiles.quantiles_from_states(dated, "precio", [0.25, 0.5, 0.75], stored, ["anio"])
    named = [F.col("cuantiles")[i].alias(q) for i, q in enumerate(("q1", "mediana", "q3"))]
    return rounded(found.select("anio", F.col("n").alias("cantidad"), *named), 6, "q1", "mediana", "q3")


@query
def price_sample(spark, folder):
    """A tenth of the lines, by a hash of their keys: the same lines on any cluster."""
    lines = tables.table(spark, folder, "lineitem")
    return profile.keyed_sample(lines, ["l_orderkey", "l_linenumber"], 0.1).select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("precio")
    )


# --- dashboard --------------------------------------------------------------------------

on_mart("variation_trimmed", lambda m: dashboard.trim_variation(variation(m)))
on_mart("dispersion_trimmed", lambda m: dashboard.trim_dispersion(dispersion(m)))
on_mart("integrated_dispersion_variation", integrated)
on_mart("integrated_join", lambda m: dashboard.integrate(dispersion(m), variation(m)))
on_mart("integrated_filtered", lambda m: dashboard.trim_integrated(integrated(m)))
on_mart(
    "top10_products_series", lambda m: dashboard.top_series(names(m), "producto", "precio_promedio", 10)
)
on_mart("top8_stores_series", lambda m: dashboard.top_series(costs(m), "supermercado", "costo_canasta", 8))
on_mart(
    "avg_price_yearly_stats",
    lambda m: rounded(
        dashboard.group_stats(names(m), "anio", "precio_promedio").drop("std"), 6, "mean", "median"
    ),
)
on_mart(
    "basket_store_stats",
    lambda m: rounded(
        dashboard.group_stats(
            ranking.in_top_groups(costs(m), "supermercado", 8), "supermercado", "costo_canasta"
        ),
        6, "mean", "median", "std",
    ),
)


def overview(mart: Mart) -> DataFrame:
    return dashboard.monthly_overview(combined(mart), costs(mart), mart.price_scale)


MONTHLY = ("precio_promedio", "variacion_pct", "indice_dispersion", "costo_canasta")
on_mart("dashboard_monthly", lambda m: rounded(overview(m), 7, *MONTHLY))
on_mart("dashboard_trend", lambda m: rounded(dashboard.trend(overview(m)), 6, "promedio"))
on_mart(
    "dispersion_trimmed_monthly",
    lambda m: rounded(
        dashboard.trim_dispersion(dispersion(m))
        .groupBy(dashboard.period().alias("fecha"))
        .agg(F.avg("indice_dispersion").alias("indice_dispersion")),
        6, "indice_dispersion",
    ),
)
on_mart(
    "top_expensive", lambda m: rounded(dashboard.leaders(names(m), "precio_promedio", F.avg), 6, "valor")
)
on_mart(
    "top_cheap",
    lambda m: rounded(dashboard.leaders(names(m), "precio_promedio", F.avg, descending=False), 6, "valor"),
)
on_mart(
    "top_volatile", lambda m: rounded(dashboard.leaders(variation(m), "variacion_pct", F.stddev_samp), 6, "valor")
)
on_mart(
    "top_dispersed", lambda m: rounded(dashboard.leaders(dispersion(m), "indice_dispersion", F.avg), 6, "valor")
)
MOVE = ("producto", "anio", "mes", "variacion_pct")
on_mart(
    "top_price_drops",
    lambda m: dashboard.extreme_rows(variation(m).select(*MOVE), "variacion_pct", 5, False),
)
on_mart(
    "top_price_rises",
    lambda m: dashboard.extreme_rows(variation(m).select(*MOVE), "variacion_pct", 5, True),
)
on_mart("top_price_ranges", lambda m: dashboard.price_ranges(names(m), 15))
on_mart(
    "top_dispersion_rows",
    lambda m: dashboard.extreme_rows(
        dispersion(m).select("producto", "anio", "mes", "indice_dispersion"), "indice_dispersion", 10, True
    ),
)
on_mart("ranking_latest_top15", lambda m: dashboard.cheapest_latest(ranked(m), 15))
on_mart("ranking_latest_bottom5", lambda m: dashboard.dearest_latest(ranked(m), 5))
on_mart(
    "metric_correlation",
    lambda m: rounded(dashboard.correlation(dashboard.trim_integrated(integrated(m))), 6, "correlacion"),
)
on_mart(
    "density_dispersion_variation",
    lambda m: profile.density(
        dashboard.trim_integrated(integrated(m)), "indice_dispersion", "variacion_pct", 30
    ),
)
on_mart("dispersion_bands", lambda m: dashboard.dispersion_bands(dispersion(m)))


@query
def exec_summary(spark, folder):
    mart = tables.mart(spark, folder)
    found = dashboard.executive_summary(scale.cut(combined(mart)), scale.cut(costs(mart)))
    return rounded(
        found, 6, "precio_promedio_general", "variacion_promedio", "dispersion_promedio",
        "dispersion_mediana", "costo_promedio", "costo_diferencia", "diferencia_precio", "diferencia_pct",
    )


@query
def display_rounded_quantities(spark, folder):
    """Eighths of quantities, many of them exactly between two cents, rounded half to even."""
    lines = tables.table(spark, folder, "lineitem")
    return dashboard.display_rounded(lines.select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 8).alias("octavo")))
