import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("gondola-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(frame, *columns):
    """The frame's rows as a sorted list of tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture
def small_mart(spark):
    """Two stores sharing the January minimum, a product without February, a store name
    that is missing, two presentations of one product name."""
    from gondola.operators.facts import Dimension, Mart

    fact = spark.sql(
        """SELECT * FROM VALUES
        (DATE'2025-01-05', 1, 10, 100.50D, 0), (DATE'2025-01-05', 1, 11, 100.50D, 1),
        (DATE'2025-01-20', 1, 12, 130.00D, 0), (DATE'2025-03-02', 1, 10, 120.60D, 0),
        (DATE'2025-01-07', 2, 10, 50.00D, 0), (DATE'2025-02-07', 2, 11, 75.00D, 0),
        (DATE'2025-02-08', 2, 12, 25.00D, 1), (DATE'2025-02-09', 3, 10, 9.99D, 0)
        AS t(fecha, producto_id, establecimiento_id, precio, oferta)"""
    )
    products = spark.sql(
        """SELECT * FROM VALUES (1, 'Arroz blanco'), (2, 'Manteca'), (3, 'Manteca')
        AS t(producto_id, nombre)"""
    ).selectExpr("*", "nombre AS categoria")
    stores = spark.sql(
        """SELECT * FROM VALUES (10, 'Sur', 'A'), (11, 'Norte', NULL), (12, NULL, 'B')
        AS t(establecimiento_id, nombre, cadena)"""
    ).selectExpr("*", "coalesce(cadena, 'Sin Cadena') AS cadena_normalizada")
    places = spark.sql(
        """SELECT * FROM VALUES (10, 'Rocha', 10), (11, 'Salto', 11), (12, 'Rocha', 12)
        AS t(establecimiento_id, departamento, ubicacion_id)"""
    )
    return Mart(
        fact,
        Dimension(lambda: products, "producto_id"),
        Dimension(lambda: stores, "establecimiento_id"),
        Dimension(lambda: places, "establecimiento_id"),
    )
