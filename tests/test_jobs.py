from pathlib import Path

import pytest
from conftest import rows
from test_cleaning import PRICES, PRODUCTS, STORES, folder  # noqa: F401

from gondola.plans import jobs
from gondola.sources.lake import Lake
from gondola.streaming import arrivals

NAMES = ("Azúcar blanco", "Limón")


def exports(spark, base):
    lake = Lake(spark, base)
    names = ("precio_promedio", "min_max_precios", "dispersion_precios", "variacion_mensual",
             "canasta_basica", "ranking_supermercados")
    found = {n: lake.read("exports_dashboard", n) for n in names}
    first = ("producto", "supermercado", "anio", "mes")  # partition columns come last in a stored table
    return {n: rows(t, *[c for c in first if c in t.columns], *[c for c in t.columns if c not in first]) for n, t in found.items()}


def test_chain_from_files_to_metrics(spark, folder, tmp_path):  # noqa: F811
    base = str(tmp_path / "lake")
    jobs.run_all(spark, str(folder), base, NAMES)
    lake = Lake(spark, base)
    assert lake.read("raw", "precios").count() == 6
    assert lake.read("landing", "_auditoria").filter("archivo = 'precios'").first().filas == 14
    fact = lake.read("refined", "fact_precios")
    assert fact.count() == 3
    assert rows(fact.groupBy("fecha").count(), "count") == [(1,), (2,)]
    first = exports(spark, base)
    assert first["precio_promedio"] == [("Azúcar blanco", 2025, 1, 77.0)]
    assert first["canasta_basica"] == [("Uno Centro", 2025, 1, 231.0)]
    assert first["ranking_supermercados"] == [("Uno Centro", 2025, 1, 231.0, 1)]
    jobs.run_all(spark, str(folder), base, NAMES)
    assert exports(spark, base) == first

    jobs.build_metrics_by_id(spark, base, NAMES)
    extremes = lake.read("exports_dashboard", "por_producto/min_max_precios").first()
    assert (extremes.precio_minimo, extremes.precio_maximo) == (30.0, 100.5)
    assert extremes.establecimiento_mas_barato == "Uno Centro"
    assert jobs.run_quality(spark, base) is False
    report = lake.read("exports_dashboard", "data_quality_report")
    assert report.count() == 20
    assert rows(report.filter("NOT passed"), "message") == [("fact_precios.oferta consistency: 1 of 3",)]


def test_quality_follows_the_refined_zone(spark, folder, tmp_path):  # noqa: F811
    (folder / "precios.csv").write_text(PRICES.replace("30,1.0,10,,", "30,1.0,10,1,"))
    base = str(tmp_path / "lake")
    jobs.run_all(spark, str(folder), base, NAMES)
    assert jobs.run_quality(spark, base) is True
    lake = Lake(spark, base)
    stores = lake.read("refined", "dim_establecimiento").filter("establecimiento_id = 11")
    lake.replace("refined", "otro", stores)
    lake.replace("refined", "dim_establecimiento", lake.read("refined", "otro"))
    assert jobs.run_quality(spark, base) is False


def test_ingest_refuses_incomplete_sources(spark, folder, tmp_path):  # noqa: F811
    (folder / "productos.csv").write_text("id.producto;producto\n1;x\n", encoding="iso-8859-1")
    with pytest.raises(ValueError, match="productos: marca"):
        jobs.ingest(spark, str(folder), str(tmp_path / "lake"))


def test_partition_replacement_leaves_other_partitions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    old = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(v, p)")
    lake.replace_partitions("refined", "t", old, ("p",))
    new = spark.sql("SELECT 3 AS v, 'b' AS p")
    assert rows(lake.replace_partitions("refined", "t", new, ("p",), only_present=True), "v", "p") == [(1, "a"), (3, "b")]
    assert rows(lake.replace_partitions("refined", "t", new, ("p",)), "v", "p") == [(3, "b")]


def test_new_price_files_are_taken_once(spark, folder, tmp_path):  # noqa: F811
    base = str(tmp_path / "lake")
    jobs.ingest(spark, str(folder), base)
    jobs.build_raw(spark, base)
    columns = PRICES.splitlines()[0].split(",")
    daily = tmp_path / "lake" / "landing" / "diario"
    daily.mkdir()
    (daily / "d1.csv").write_text(",".join(columns) + "\n2025-02-01,55.5,1,10,0,\n2025-02-01,bad,1,10,0,\n")
    arrivals.take_new_files(spark, base, "diario/*.csv", columns)
    assert arrivals.raw_prices(spark, base).count() == 7
    (daily / "d2.csv").write_text(",".join(columns) + "\n2025-02-02,60,1,10,0,\n")
    arrivals.take_new_files(spark, base, "diario/*.csv", columns)
    arrivals.take_new_files(spark, base, "diario/*.csv", columns)
    assert arrivals.raw_prices(spark, base).count() == 8
    jobs.build_dims(spark, base)
    by_month = jobs.build_fact(spark, base)
    assert rows(by_month.groupBy("anio", "mes").count()) == [(2025, 1, 3), (2025, 2, 2)]
    stored = rows(by_month, "fecha", "precio")
    by_date = jobs.build_fact(spark, base, by_date=True)
    assert by_date.inputFiles()[0].split("/")[-2].startswith("fecha=")
    assert rows(by_date, "fecha", "precio") == stored


def yearly(folder, year, header, *lines):
    (folder / str(year)).mkdir(parents=True)
    (folder / str(year) / f"precios_{year}.csv").write_text("\n".join([header, *lines]) + "\n")


def test_yearly_files_are_read_by_column_name(spark, tmp_path):
    from gondola.sources import csvfiles

    assert csvfiles.read_yearly_prices(spark, str(tmp_path)).count() == 0
    yearly(tmp_path, 2023, "Fecha,Precio,Presentacion_Producto,Establecimiento,Oferta", "2023-05-01,10.5,7,3,0")
    yearly(tmp_path, 2024, "Fecha,Presentacion_Producto,Establecimiento,Precio,Oferta", "2024-05-01,8,4,99.5,1")
    found = csvfiles.read_yearly_prices(spark, str(tmp_path))
    assert rows(found, "anio_archivo", "Precio", "Presentacion_Producto", "Establecimiento") == [
        (2023, "10.5", "7", "3"), (2024, "99.5", "8", "4"),
    ]
    yearly(tmp_path, 2025, "Fecha,Precio,Establecimiento,Oferta", "2025-05-01,1,4,1")
    with pytest.raises(ValueError, match="Presentacion_Producto"):
        csvfiles.read_yearly_prices(spark, str(tmp_path))


def test_files_read_together_must_share_their_header(spark, tmp_path):
    from gondola.sources import csvfiles

    (tmp_path / "a.csv").write_text("Fecha,Precio\n2025-01-01,1\n")
    (tmp_path / "b.csv").write_text("Precio,Fecha\n1,2025-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        csvfiles.read(spark, csvfiles.PRICES, str(tmp_path)).collect()


def test_chain_takes_yearly_files(spark, folder, tmp_path):  # noqa: F811
    base = str(tmp_path / "lake")
    jobs.ingest(spark, str(folder), base)
    landing = tmp_path / "lake" / "landing"
    yearly(landing, 2023, "Fecha,Presentacion_Producto,Establecimiento,Precio,Oferta", "2023-05-01,1,10,50,0")
    yearly(landing, 2024, "Fecha,Precio,Presentacion_Producto,Establecimiento,Oferta", "2024-05-01,60,1,10,0")
    jobs.build_raw(spark, base)
    jobs.build_dims(spark, base)
    fact = jobs.build_fact(spark, base)
    assert rows(fact.filter("anio < 2025"), "anio", "precio") == [(2023, 50.0), (2024, 60.0)]


def test_a_refreshed_batch_supersedes_arrivals(spark, folder, tmp_path):  # noqa: F811
    base = str(tmp_path / "lake")
    header = PRICES.splitlines()[0]
    (folder / "precios.csv").write_text(f"{header}\n2025-03-01,10,1,10,0,\n")
    jobs.ingest(spark, str(folder), base)
    jobs.build_raw(spark, base)
    daily = tmp_path / "lake" / "landing" / "diario"
    daily.mkdir()
    (daily / "d2.csv").write_text(f"{header}\n2025-03-02,20,1,10,0,\n")
    arrivals.take_new_files(spark, base, "diario/*.csv", header.split(","))
    assert arrivals.raw_prices(spark, base).count() == 2
    (folder / "precios.csv").write_text(f"{header}\n2025-03-01,10,1,10,0,\n2025-03-02,20,1,10,0,\n")
    jobs.ingest(spark, str(folder), base)
    jobs.build_raw(spark, base)
    assert rows(arrivals.raw_prices(spark, base), "precio") == [(10.0,), (20.0,)]


def test_landing_keeps_blanks_and_malformed_rows(spark, folder, tmp_path):  # noqa: F811
    base = str(tmp_path / "lake")
    header, *rest = PRODUCTS.splitlines()
    fields = len(header.split(";"))
    padded = ";".join(["77", "  Arroz blanco ", *["x"] * (fields - 2)])
    long = ";".join(["78", *["y"] * fields])
    (folder / "productos.csv").write_text("\n".join([header, *rest, padded, long]) + "\n", encoding="iso-8859-1")
    jobs.ingest(spark, str(folder), base)
    lake = Lake(spark, base)
    landed = spark.read.options(sep=";", header="true", encoding="ISO-8859-1").csv(lake.path("landing", "productos.csv"))
    assert landed.filter("`id.producto` = '77'").first().producto == "  Arroz blanco "
    assert lake.read("landing", "_auditoria").filter("archivo = 'productos'").first().malformadas >= 1
    assert long in [r.texto for r in lake.read("landing", "_malformadas/productos").collect()]


HEADER = "Fecha,Precio,Presentacion_Producto,Establecimiento,Oferta"


def lake_of(spark, folder, tmp_path, *prices):
    """A lake whose load has these price lines; the source is as old as its writing."""
    base = str(tmp_path / "lake")
    (folder / "precios.csv").write_text("\n".join([HEADER, *prices]) + "\n")
    jobs.ingest(spark, str(folder), base)
    jobs.build_raw(spark, base)
    return base


def arrive(spark, base, name, *lines):
    daily = Path(base) / "landing" / "diario"
    daily.mkdir(exist_ok=True)
    (daily / name).write_text("\n".join([HEADER, *lines]) + "\n")
    return arrivals.take_new_files(spark, base, "diario/*.csv", HEADER.split(","))


def test_later_files_add_to_a_loaded_date_and_correct_it(spark, folder, tmp_path):  # noqa: F811
    base = lake_of(spark, folder, tmp_path, "2024-01-05,10,1,10,0", "2024-01-05,10,1,10,0", "2024-01-05,11,2,10,0", ",9,1,10,0")
    months = arrive(spark, base, "d1.csv", "2024-01-05,20,1,11,0", "2024-01-06,21,1,11,0", "2024-01-05,12,2.0,10,0", "2024-02-01,x,1,10,0")
    assert months == [(2024, 1)]
    wanted = [(9.0,), (10.0,), (10.0,), (12.0,), (20.0,), (21.0,)]  # store 11 is new, product 2 corrected
    assert sorted(rows(arrivals.raw_prices(spark, base), "precio")) == wanted
    jobs.build_raw(spark, base)  # again, without any change of the sources
    assert sorted(rows(arrivals.raw_prices(spark, base), "precio")) == wanted
    arrive(spark, base, "d2.csv", "2024-01-05,22,1,11,0", "2024-01-05,22,1,11,0", ",8,1,11,0")
    found = arrivals.raw_prices(spark, base)
    assert sorted(rows(found, "precio")) == [(8.0,), (9.0,), (10.0,), (10.0,), (12.0,), (21.0,), (22.0,), (22.0,)]
    told = {r.archivo.split("/")[-1]: r for r in arrivals.audit(spark, base).collect()}
    count = lambda r: (r.leidas, r.validas, r.vigentes, r.reemplazadas)
    assert (count(told["d1.csv"]), count(told["d2.csv"])) == ((4, 3, 2, 1), (3, 3, 3, 0))
    assert Lake(spark, base).read("raw", "_auditoria_arribos").count() == 2


def test_a_fuller_load_takes_over_what_came_daily(spark, folder, tmp_path):  # noqa: F811
    base = lake_of(spark, folder, tmp_path, "2024-01-05,10,1,10,0")
    arrive(spark, base, "d1.csv", "2024-01-06,20,1,10,0", "2024-01-06,21,1,11,0")
    assert sorted(rows(arrivals.raw_prices(spark, base), "precio")) == [(10.0,), (20.0,), (21.0,)]
    lake_of(spark, folder, tmp_path, "2024-01-05,10,1,10,0", "2024-01-06,20,1,10,0")
    found = rows(arrivals.raw_prices(spark, base), "precio")
    assert sorted(found) == [(10.0,), (20.0,), (21.0,)]  # once each; what the load lacks stays
    told = arrivals.audit(spark, base).first()
    assert (told.validas, told.vigentes, told.reemplazadas) == (2, 1, 1)


def test_without_arrivals_the_audit_is_empty(spark, folder, tmp_path):  # noqa: F811
    base = lake_of(spark, folder, tmp_path, "2024-01-05,10,1,10,0")
    assert arrivals.audit(spark, base).count() == 0
    assert arrivals.raw_prices(spark, base).columns == ["fecha", "producto_id", "establecimiento_id", "precio", "oferta"]


@pytest.mark.parametrize("by_date", [False, True])
def test_months_that_are_gone_leave_the_fact(spark, folder, tmp_path, by_date):  # noqa: F811
    lines = [f"2024-0{m}-05,{m},1,10,0" for m in (1, 2, 3)]
    base = lake_of(spark, folder, tmp_path, *lines)
    jobs.build_dims(spark, base)
    assert jobs.build_fact(spark, base, by_date=by_date).count() == 3
    lake_of(spark, folder, tmp_path, lines[0], lines[2].replace(",3,", ",4,"))
    assert rows(jobs.build_fact(spark, base, by_date=by_date, since="2024-02-15"), "precio") == [(1.0,), (4.0,)]
    lake_of(spark, folder, tmp_path, lines[0])
    assert rows(jobs.build_fact(spark, base, by_date=by_date, months=[(2024, 3)]), "precio") == [(1.0,)]
    lake_of(spark, folder, tmp_path, "2023-01-05,1,999,10,0")
    assert jobs.build_fact(spark, base, by_date=by_date, since="2020-01-01").count() == 0


def test_partitions_outside_the_replaced_ones_stay(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    old = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (3, 'c:d') AS t(v, p)")
    lake.replace_partitions("refined", "t", old, ("p",))
    new = spark.sql("SELECT 9 AS v, 'e' AS p")
    within = lambda p: p["p"] != "a"
    for _ in range(2):  # again ends in the same state
        assert rows(lake.replace_partitions("refined", "t", new, ("p",), within=within), "v", "p") == [(1, "a"), (9, "e")]
    assert rows(lake.replace_partitions("refined", "new", new, ("p",), within=within), "v", "p") == [(9, "e")]


def tables_of(spark, base):
    lake = Lake(spark, base)
    found = exports(spark, base) | {t: rows(lake.read("refined", t)) for t in ("fact_precios", jobs.CUBE, "precios_mensuales", "dim_tiempo")}
    return {name: [tuple(sorted(map(str, r))) for r in table] for name, table in found.items()}


def test_changed_months_alone_equal_building_everything(spark, folder, tmp_path):  # noqa: F811
    lines = [f"{y}-{m:02d}-03,{100 + 7 * y % 13 + m},{p},{s},0" for y in (2023, 2024) for m in range(1, 13, 2) for p in (1, 2) for s in (10, 11)]
    lines = [x for x in lines if not x.startswith("2023-11") or ",2," not in x]
    base = lake_of(spark, folder, tmp_path, *lines)
    jobs.build_dims(spark, base)
    jobs.build_fact(spark, base)
    jobs.build_cube(spark, base, 2)
    jobs.build_metrics(spark, base, NAMES, 2)
    before = tables_of(spark, base)
    months = arrive(
        spark, base, "late.csv", "2023-09-03,500.25,1,10,0",  # a correction: the next month of its series is in two months
        "2023-11-03,77,2,11,0", "2023-12-20,60,2,10,0",  # months product 2 did not have; its next one is in another year
    )
    assert months == [(2023, 9), (2023, 11), (2023, 12)]
    jobs.run_changed(spark, base, months, NAMES, 2)
    incremental = tables_of(spark, base)
    jobs.build_dims(spark, base)
    jobs.build_fact(spark, base)
    jobs.build_cube(spark, base, 2)
    jobs.build_metrics(spark, base, NAMES, 2)
    assert incremental == tables_of(spark, base) != before
    jobs.run_changed(spark, base, [], NAMES, 2)
    assert tables_of(spark, base) == incremental


def test_months_after_a_change(spark):
    from gondola.operators import metrics

    prices = spark.createDataFrame([("a", 2023, 12), ("a", 2024, 3), ("a", 2024, 5), ("b", 2024, 2), ("b", 2024, 4), (None, 2025, 1)], "producto string, anio int, mes int")
    assert metrics.months_after(prices, [(2023, 12)]) == {(2024, 3), (2024, 2), (2025, 1)}
    assert metrics.months_after(prices, [(2024, 2), (2024, 3)]) == {(2024, 5), (2024, 4), (2025, 1)}
    assert metrics.months_after(prices, []) == set()


def test_ingest_lands_yearly_files(spark, folder, tmp_path):  # noqa: F811
    yearly(folder, 2023, "Fecha,Presentacion_Producto,Establecimiento,Precio,Oferta", "2023-05-01,1,10,50,0", "2023-05-02,1,10,60,0,extra")
    (folder / "2022").mkdir()
    (folder / "2022" / "precios_2021.csv").write_text(HEADER + "\n2021-01-01,1,1,10,0\n")
    base = str(tmp_path / "lake")
    jobs.ingest(spark, str(folder), base)
    log = {r.archivo: r for r in Lake(spark, base).read("landing", "_auditoria").collect()}
    assert log.keys() == {"precios", "productos", "establecimientos", "2023/precios_2023"}
    assert (log["2023/precios_2023"].filas, log["2023/precios_2023"].malformadas) == (2, 1)
    assert all(r.fuente_en is not None for r in log.values())
    jobs.build_raw(spark, base)
    assert rows(Lake(spark, base).read("raw", "precios").filter("year(fecha) = 2023"), "precio") == [(50.0,), (60.0,)]
    yearly(folder, 2024, "Fecha,Precio,Establecimiento,Oferta", "2024-05-01,1,4,1")
    with pytest.raises(ValueError, match="2024/precios_2024: Presentacion_Producto"):
        jobs.ingest(spark, str(folder), base)
