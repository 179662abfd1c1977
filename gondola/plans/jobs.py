"""The batch chain over a lake: ingest, raw, dimensions, fact, metrics, quality.

Every job reads the previous zone's files and replaces its own tables, so any job can be
repeated alone with the same result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from gondola.operators import basket, cleaning, cube, dimensions, facts, metrics, quality
from gondola.operators.ownership import WRITTEN
from gondola.sources import csvfiles
from gondola.sources.lake import Lake, Partition
from gondola.streaming import arrivals
from gondola.streaming.arrivals import raw_prices

CUBE = "cubo_mensual"
MONTH = ("anio", "mes")
Months = Iterable[tuple[int, int]]


def in_months(months: Months) -> Column:
    """Whether a row's month (columns anio, mes) is one of them; prunes partitions of those columns."""
    by_year: dict[int, list[int]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    parts = [(F.col("anio") == y) & F.col("mes").isin(m) for y, m in sorted(by_year.items())]
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def named_months(months: Months) -> Callable[[Partition], bool]:
    """The same for a partition of the lake."""
    wanted = set(months)
    return lambda p: p["mes"].isdigit() and (int(p["anio"]), int(p["mes"])) in wanted


def together(*actions: Callable[[], object]) -> list:
    """Results of independent jobs, submitted at once so that small ones fill the cluster side
    by side; the first error is raised after all have ended."""
    with ThreadPoolExecutor(len(actions)) as pool:
        return [done.result() for done in [pool.submit(a) for a in actions]]


def ingest(spark: SparkSession, source: str, base: str) -> DataFrame:
    """Check the headers of the three source files and of the yearly price files there are
    (<year>/precios_<year>.csv), then store the files in landing in the same format, with an audit
    table. Fields keep their blanks; the text of rows with too few or too many fields is also
    stored as it is, under landing/_malformadas, and counted. Rows are counted while they are
    written, and the audit says when the source file was last written. Raises when a file is
    missing or incomplete, before anything is written."""
    lake = Lake(spark, base)
    found = csvfiles.find(spark, source)
    gaps = {file.name: csvfiles.missing_columns(file, rows) for file, rows in found.items()}
    yearly = {re.search(r"[0-9]+/precios_[0-9]+(?=\.csv$)", path)[0]: path for path in csvfiles.yearly_paths(spark, source)}
    gaps |= {name: csvfiles.missing_columns(csvfiles.PRICES, csvfiles.read(spark, csvfiles.PRICES, path)) for name, path in yearly.items()}
    if any(gaps.values()):
        bad = [f"{name}: {','.join(columns)}" for name, columns in gaps.items() if columns]
        raise ValueError("source files do not meet their contract: " + "; ".join(bad))

    def land(file: csvfiles.CsvFile, name: str, path: str) -> tuple:
        seen = Observation(name)
        rows = csvfiles.read_marked(spark, file, path)
        bad = F.col(csvfiles.MALFORMED)
        counted = rows.withColumn(WRITTEN, F.col("_metadata.file_modification_time")).observe(
            seen, F.count(F.lit(1)).alias("filas"), F.count(bad).alias("malformadas"), F.max(WRITTEN).alias(WRITTEN)
        )
        counted.drop(csvfiles.MALFORMED, WRITTEN).write.mode("overwrite").options(
            **file.options, header="true", emptyValue="",
            ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        ).csv(lake.path("landing", f"{name}.csv"))
        key = F.col(f"`{rows.columns[0]}`").alias("clave")  # a CSV source must be asked for some field of its own
        lost = rows.filter(F.coalesce(bad, F.lit("")) != "").select(key, bad.alias("texto"))  # not pushed into the scan
        lake.replace("landing", f"_malformadas/{name}", lost)
        return name, seen.get["filas"], seen.get["malformadas"], seen.get[WRITTEN]

    counts = together(
        *[partial(land, file, file.name, f"{source}/{file.name}.csv") for file in found],
        *[partial(land, csvfiles.PRICES, name, path) for name, path in yearly.items()],
    )
    log = spark.createDataFrame(counts, f"archivo string, filas bigint, malformadas bigint, {WRITTEN} timestamp").withColumn(
        "ingerido_en", F.current_timestamp()
    )
    return lake.replace("landing", "_auditoria", log)


def build_raw(spark: SparkSession, base: str) -> None:
    """Clean the landing files. Prices are those of precios.csv and of every yearly file, with the time
    their source file was last written: the audit's, or that of a file put into landing by hand.
    That time, and not the time of this job, settles what later arrivals correct, so the job can
    be repeated. Arrivals there are get their account."""
    lake = Lake(spark, base)
    landing = lake.path("landing")
    own = F.col("_metadata.file_modification_time")
    logged = lake.read("landing", "_auditoria")
    known = {r.archivo: r[WRITTEN] for r in logged.collect()} if WRITTEN in logged.columns else {}  # a row for each file

    def written(name: Column) -> Column:
        times = [(F.lit(k), F.lit(t)) for k, t in known.items() if t is not None]
        return F.coalesce(F.element_at(F.create_map(*[x for pair in times for x in pair]), name), own) if times else own

    base_file = csvfiles.read(spark, csvfiles.PRICES, f"{landing}/precios.csv").withColumn(WRITTEN, written(F.lit("precios")))
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([0-9]+/precios_[0-9]+)\.csv", 1)
    yearly = csvfiles.read_yearly_prices(spark, landing, {WRITTEN: written(name)}).drop("anio_archivo")
    prices = base_file.unionByName(yearly, allowMissingColumns=True)
    products = csvfiles.read(spark, csvfiles.PRODUCTS, f"{landing}/productos.csv")
    stores = csvfiles.read(spark, csvfiles.STORES, f"{landing}/establecimientos.csv")
    together(
        lambda: lake.replace("raw", "precios", cleaning.clean_prices(prices, (WRITTEN,))),
        lambda: lake.replace("raw", "productos", cleaning.clean_products(products)),
        lambda: lake.replace("raw", "establecimientos", cleaning.clean_stores(stores)),
    )
    arrivals.audit(spark, base)


def build_dims(spark: SparkSession, base: str) -> None:
    lake = Lake(spark, base)
    stores = lake.read("raw", "establecimientos")
    together(
        lambda: lake.replace("refined", "dim_tiempo", dimensions.dim_time(raw_prices(spark, base))),
        lambda: lake.replace("refined", "dim_producto", dimensions.dim_product(lake.read("raw", "productos"))),
        lambda: lake.replace("refined", "dim_establecimiento", dimensions.dim_store(stores)),
        lambda: lake.replace("refined", "dim_ubicacion", dimensions.dim_location(stores)),
    )


def stored_dimensions(lake: Lake) -> list[facts.Dimension]:
    """Products, stores and locations of the refined zone."""
    keys = {"dim_producto": "producto_id", "dim_establecimiento": "establecimiento_id",
            "dim_ubicacion": "establecimiento_id"}
    return [facts.Dimension(partial(lake.read, "refined", t), k) for t, k in keys.items()]


def build_fact(
    spark: SparkSession, base: str, by_date: bool = False, since: str | None = None, months: Months | None = None
) -> DataFrame:
    """The fact table, or only its months from the one of `since` (a day, as text) on, or only those
    of `months`: these are replaced completely, also where no observation of them is left, other
    partitions stay as they are and their observations are not read. By default it is
    partitioned by month, the period of the metrics, with files ordered by date: partitions stay
    large enough to scan well, and a date range still skips row groups. by_date partitions by
    date instead, for very many rows a day."""
    lake = Lake(spark, base)
    prices = raw_prices(spark, base).withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})
    of_month = None
    if months is not None:
        months = list(months)
        prices, of_month = prices.filter(in_months(months)), named_months(months)
    elif since is not None:
        first = tuple(int(x) for x in since.split("-")[:2])
        prices = prices.filter(F.col("fecha") >= F.trunc(F.lit(since).cast("date"), "month"))
        of_month = lambda p: p["mes"].isdigit() and (int(p["anio"]), int(p["mes"])) >= first
    fact = facts.fact_prices(
        prices,
        *stored_dimensions(lake),
        facts.Dimension(lambda: lake.read("refined", "dim_tiempo").select("fecha"), "fecha"),
    )
    if by_date:
        month = lambda p: dict(zip(MONTH, [*p["fecha"].split("-")[:2], ""]))
        of_day = of_month and (lambda p: of_month(month(p)))
        return lake.replace_partitions("refined", "fact_precios", fact, ("fecha",), within=of_day)
    dated = fact.withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})
    return lake.replace_partitions("refined", "fact_precios", dated, MONTH, ("fecha",), within=of_month)


def load_mart(spark: SparkSession, base: str, price_scale: int | None = None) -> facts.Mart:
    lake = Lake(spark, base)
    return facts.Mart(lake.read("refined", "fact_precios"), *stored_dimensions(lake), price_scale)


def build_cube(spark: SparkSession, base: str, price_scale: int | None = None, months: Months | None = None) -> DataFrame:
    """Store the monthly cube, partitioned by month, or replace only its partitions of `months`. It is
    the only step of the metrics that scans the fact, and it reads the partitions of those months
    alone."""
    mart = load_mart(spark, base, price_scale)
    if months is None:
        return Lake(spark, base).replace_partitions("refined", CUBE, cube.monthly_cube(mart), MONTH)
    months = list(months)
    changed = replace(mart, fact=mart.fact.filter(in_months(months)))
    return Lake(spark, base).replace_partitions("refined", CUBE, cube.monthly_cube(changed), MONTH, within=named_months(months))


def build_metrics(
    spark: SparkSession,
    base: str,
    names: Iterable[str] = basket.BASIC_BASKET,
    price_scale: int | None = None,
    months: Months | None = None,
) -> None:
    """The six metric tables at name grain, partitioned by year, from the stored cube.

    With `months`, whose partitions of the cube have changed, only the tables' partitions of their
    years are replaced, and of the changes also those of the months in which a series goes on
    after one of them: the next month that a product has, whose previous price is another now. The
    cube's other years are not read; the windows of the changes run over the stored prices
    per name and month."""
    lake = Lake(spark, base)
    mart = load_mart(spark, base, price_scale)
    stored, years = lake.read("refined", CUBE), None
    if months is not None:
        months = list(months)
        years = {y for y, _ in months}
        stored = stored.filter(F.col("anio").isin(sorted(years)))

    def export(table: str, rows: DataFrame, zone: str = "exports_dashboard", only: set[int] | None = years) -> DataFrame:
        """Writes the table, or its years `only`; gives these."""
        within = None if only is None else lambda p: int(p["anio"]) in only
        whole = lake.replace_partitions(zone, table, rows, ("anio",), within=within)
        return whole if only is None else whole.filter(F.col("anio").isin(sorted(only)))

    def of_changes() -> None:
        changes = metrics.variation_by_name(lake.read("refined", "precios_mensuales"))
        if months is None:
            export("variacion_mensual", changes)
            return
        after = metrics.months_after(lake.read("refined", "precios_mensuales"), months)
        also = years | {y for y, _ in after}
        export("variacion_mensual", changes.filter(F.col("anio").isin(sorted(also))), only=also)

    def of_prices() -> None:
        prices = export("precios_mensuales", cube.by_name_month(mart, stored), "refined")
        together(
            lambda: export("precio_promedio", metrics.average_by_name(prices)),
            lambda: export("min_max_precios", metrics.min_max(prices, metrics.NAME_KEYS)),
            lambda: export("dispersion_precios", metrics.dispersion(prices, metrics.NAME_KEYS)),
            of_changes,
        )

    def of_baskets() -> None:
        costs = export("canasta_basica", basket.cost_by_observation(mart, names, stored))
        export("ranking_supermercados", basket.rank_by_observation(costs))

    together(of_prices, of_baskets)


def run_changed(
    spark: SparkSession,
    base: str,
    months: Months,
    names: Iterable[str] = basket.BASIC_BASKET,
    price_scale: int | None = None,
) -> None:
    """Fact, cube and name-grain metrics of the months that new files brought rows of (take_new_files
    tells them); equal to building everything again. The catalogue dimensions are taken as they are."""
    months = list(months)
    if months:
        lake = Lake(spark, base)
        lake.replace("refined", "dim_tiempo", dimensions.dim_time(raw_prices(spark, base)))
        build_fact(spark, base, months=months)
        build_cube(spark, base, price_scale, months)
        build_metrics(spark, base, names, price_scale, months)


def build_metrics_by_id(
    spark: SparkSession,
    base: str,
    names: Iterable[str] = basket.BASIC_BASKET,
    price_scale: int | None = None,
) -> None:
    """The metric tables at id grain, including daily change and the stores at the
    extremes. Kept in a folder of their own, as some share a table name with name grain."""
    lake = Lake(spark, base)
    mart = load_mart(spark, base, price_scale)
    states = lake.read("refined", CUBE)
    def export(table: str, rows: DataFrame) -> DataFrame:
        return lake.replace("exports_dashboard", f"por_producto/{table}", rows)

    def of_prices() -> None:
        prices = lake.replace("refined", "precios_mensuales_producto", cube.by_product_month(mart, states))
        together(
            lambda: export("precio_promedio_producto", metrics.average_by_product(prices)),
            lambda: export("variacion_mensual", metrics.variation_by_product(prices)),
            lambda: export("dispersion_precios", metrics.dispersion(prices, metrics.ID_KEYS)),
        )

    def of_baskets() -> None:
        costs = export("canasta_basica", basket.cost_by_average(mart, names, "categoria", states))
        export("ranking_supermercados", basket.rank_by_average(costs))

    together(
        of_prices,
        of_baskets,
        lambda: export("variacion_diaria", metrics.variation_daily(cube.by_product_day(mart))),
        lambda: export("min_max_precios", metrics.price_extremes(mart, states)),
    )


def run_quality(spark: SparkSession, base: str) -> bool:
    """Check the refined zone, store report (Parquet) and summary (one JSON file), and say
    whether everything passed."""
    lake = Lake(spark, base)
    names = ("fact_precios", "dim_tiempo", "dim_producto", "dim_establecimiento", "dim_ubicacion")
    tables = {name: lake.read("refined", name) for name in names}
    results = quality.evaluate(tables, quality.STAR_CHECKS)
    stored = lake.replace("exports_dashboard", "data_quality_report", quality.report(results))
    totals = quality.summary(stored)
    totals.coalesce(1).write.mode("overwrite").json(lake.path("exports_dashboard", "quality_summary"))
    return spark.read.json(lake.path("exports_dashboard", "quality_summary")).first().all_passed


def run_all(
    spark: SparkSession,
    source: str,
    base: str,
    names: Iterable[str] = basket.BASIC_BASKET,
    price_scale: int | None = None,
) -> None:
    """Ingest to name-grain metrics, in order."""
    ingest(spark, source, base)
    build_raw(spark, base)
    build_dims(spark, base)
    build_fact(spark, base)
    build_cube(spark, base, price_scale)
    build_metrics(spark, base, names, price_scale)
