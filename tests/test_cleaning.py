import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gondola.functions import parsing
from gondola.operators import cleaning, dimensions, facts
from gondola.sources import csvfiles

PRICES = '''Fecha,Precio,Presentacion_Producto,Establecimiento,Oferta,Nota
2025-01-05,100.50,1,10,0,"a, b"
2025-01-05,100.50,1,10,0,"dijo ""si"""
2025-01-06,abc,1,10,0,
2025-01-06,,1,10,0,
2025-01-06,0,1,10,0,
2025-01-06,-5,1,10,0,
2025-01-06,NaN,1,10,0,
2025-01-06,Infinity,1,10,0,
2025-01-06,12,,10,0,
2025-01-06,12,1,,0,
05/01/2025,20,1,10,1,
2025-01-07,30,1.0,10,,
2025-01-07,31,999,10,x,
2025-01-07,32,2,998,1,
'''
PRODUCTS = """id.producto;producto;marca;especificacion;nombre;extra
1;Azúcar blanco;Z;1 kg;Azúcar Z 1 kg;e
1;Azúcar blanco;A;1 kg;Azúcar A 1 kg;e
2;Limón;;suelto;Limón suelto;
"""
STORES = """id.establecimientos;razon.social;nombre.sucursal;direccion;ciudad;depto;cadena;barrio
10;Uno SA;Uno Centro;Calle 1;Rocha;Rocha;;
11;Dos SA;Dos Centro;Calle 2;Salto;Salto;Dos;Cerro
"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "precios.csv").write_text(PRICES, encoding="utf-8")
    (tmp_path / "productos.csv").write_text(PRODUCTS, encoding="iso-8859-1")
    (tmp_path / "establecimientos.csv").write_text(STORES, encoding="iso-8859-1")
    return tmp_path


def test_prices_keep_only_valid_rows(spark, folder):
    text = csvfiles.read(spark, csvfiles.PRICES, f"{folder}/precios.csv")
    assert text.columns[-1] == "Nota"
    assert text.filter("Nota = 'a, b'").count() == 1 and text.filter("Nota = 'dijo \"si\"'").count() == 1
    day = dt.date(2025, 1, 5)
    assert rows(cleaning.clean_prices(text)) == [
        (day, "1", "10", 100.5, 0),
        (day, "1", "10", 100.5, 0),
        (dt.date(2025, 1, 7), "1.0", "10", 30.0, None),
        (dt.date(2025, 1, 7), "2", "998", 32.0, 1),
        (dt.date(2025, 1, 7), "999", "10", 31.0, None),
        (None, "1", "10", 20.0, 1),
    ]


def test_catalogues_keep_one_row_per_key_and_their_extra_columns(spark, folder):
    products = cleaning.clean_products(csvfiles.read(spark, csvfiles.PRODUCTS, f"{folder}/productos.csv"))
    assert rows(products, "producto_id", "marca", "categoria", "subcategoria", "extra") == [
        ("1", "A", "Azúcar blanco", "1 kg", "e"),
        ("2", None, "Limón", "suelto", None),
    ]


def test_dimensions_and_fact(spark, folder):
    prices = cleaning.clean_prices(csvfiles.read(spark, csvfiles.PRICES, f"{folder}/precios.csv"))
    products = cleaning.clean_products(csvfiles.read(spark, csvfiles.PRODUCTS, f"{folder}/productos.csv"))
    stores = cleaning.clean_stores(csvfiles.read(spark, csvfiles.STORES, f"{folder}/establecimientos.csv"))
    product, store = dimensions.dim_product(products), dimensions.dim_store(stores)
    place, time = dimensions.dim_location(stores), dimensions.dim_time(prices)
    assert rows(store, "establecimiento_id", "nombre", "cadena", "cadena_normalizada") == [
        (10, "Uno Centro", None, "Sin Cadena"), (11, "Dos Centro", "Dos", "Dos"),
    ]
    assert rows(place, "ubicacion_id", "departamento", "barrio") == [(10, "Rocha", "Sin Barrio"), (11, "Salto", "Cerro")]
    assert rows(product, "producto_id", "nombre_completo", "nombre") == [
        (1, "Azúcar A 1 kg", "Azúcar blanco"), (2, "Limón suelto", "Limón"),
    ]
    assert rows(time, "fecha_id") == [(20250105,), (20250107,)]
    built = [
        facts.Dimension(lambda f=f: f, k)
        for f, k in ((product, "producto_id"), (store, "establecimiento_id"), (place, "establecimiento_id"))
    ]
    fact = facts.fact_prices(prices, *built)
    assert rows(fact, "fecha_id", "producto_id", "establecimiento_id", "ubicacion_id", "precio") == [
        (20250105, 1, 10, 10, 100.5), (20250105, 1, 10, 10, 100.5), (20250107, 1, 10, 10, 30.0),
    ]
    one_day = facts.Dimension(lambda: time.filter("fecha_id = 20250107").select("fecha"), "fecha")
    assert facts.fact_prices(prices, *built, one_day).count() == 1


def test_calendar_of_a_year_end(spark):
    prices = spark.sql("SELECT DATE'2024-12-30' AS fecha UNION ALL SELECT CAST(NULL AS DATE)")
    assert rows(dimensions.dim_time(prices)) == [
        (dt.date(2024, 12, 30), 20241230, 2024, 12, 30, 4, 2, 1, "December", "Monday")
    ]


@pytest.mark.parametrize(
    "text, day, number, price",
    [
        ("2025-01-05", dt.date(2025, 1, 5), None, None),
        ("2025-1-5", None, None, None),
        ("2025-02-30", None, None, None),
        (" 7 ", None, 7, 7.0),
        ("1.0", None, 1, 1.0),
        ("99999999999", None, None, 99999999999.0),
        ("1e400", None, None, None),
        ("-Infinity", None, None, None),
        ("", None, None, None),
        (None, None, None, None),
    ],
)
def test_parsing_never_raises(spark, text, day, number, price):
    cell = spark.createDataFrame([(text,)], "t string").select(
        parsing.as_date(F.col("t")), parsing.as_int(F.col("t")), parsing.as_price(F.col("t"))
    )
    assert tuple(cell.first()) == (day, number, price)


def test_contract_and_audit(spark, folder):
    found = csvfiles.find(spark, str(folder))
    assert rows(csvfiles.contract(found, spark), "archivo", "existe", "filas", "passed") == [
        ("establecimientos", True, 2, True), ("precios", True, 14, True), ("productos", True, 3, True),
    ]
    (folder / "productos.csv").write_text("id.producto;producto\n1;x\n", encoding="iso-8859-1")
    found = csvfiles.find(spark, str(folder))
    found[csvfiles.STORES] = None
    bad = csvfiles.contract(found, spark)
    assert rows(bad, "archivo", "existe", "columnas_faltantes", "passed") == [
        ("establecimientos", False, ",".join(csvfiles.STORES.required), False),
        ("precios", True, "", True),
        ("productos", True, "marca,especificacion,nombre", False),
    ]
    assert csvfiles.find(spark, str(folder / "nada"))[csvfiles.PRICES] is None
    text = csvfiles.read(spark, csvfiles.PRICES, f"{folder}/precios.csv")
    audited = csvfiles.audit({"precios": text}, {"precios": cleaning.clean_prices(text)})
    assert rows(audited) == [("precios", 14, 6, 1)]


def test_yearly_files(spark, tmp_path):
    header = "Fecha,Precio,Presentacion_Producto,Establecimiento,Oferta\n"
    for place, name in (("2023", "precios_2023"), ("2024", "precios_2024"), ("2024", "precios_2023")):
        (tmp_path / place).mkdir(exist_ok=True)
        (tmp_path / place / f"{name}.csv").write_text(header + f"{place}-05-01,1.5,1,1,0\n")
    (tmp_path / "2022").mkdir()
    (tmp_path / "viejo").mkdir()
    (tmp_path / "viejo" / "precios_2021.csv").write_text(header + "2021-05-01,1.5,1,1,0\n")
    yearly = csvfiles.read_yearly_prices(spark, str(tmp_path))
    assert rows(yearly, "anio_archivo", "Fecha") == [(2023, "2023-05-01"), (2024, "2024-05-01")]
