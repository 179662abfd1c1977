"""The star-schema test tables seen as a price mart.

Line items are price observations, parts are products, suppliers are stores placed in
their nation (city) and region. Prices have two decimals.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.functions import calendar
from gondola.operators import dimensions
from gondola.operators.facts import Dimension, Mart

PRICE_SCALE = 2

# Schemas of the tables' columns in use.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """Raw price observations."""
    return table(spark, folder, "lineitem").selectExpr(
        "CAST(l_shipdate AS DATE) AS fecha",
        "CAST(l_partkey AS INT) AS producto_id",
        "CAST(l_suppkey AS INT) AS establecimiento_id",
        "l_extendedprice AS precio",
        "IF(l_discount > 0, 1, 0) AS oferta",
    )


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """The observations with all keys. Foreign keys are not enforced, so that the quality
    checks have something to find."""
    return prices(spark, folder).select(
        calendar.date_key(F.col("fecha")).alias("fecha_id"),
        "producto_id",
        "establecimiento_id",
        F.col("establecimiento_id").alias("ubicacion_id"),
        "precio",
        "oferta",
        "fecha",
    )


def dim_time(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_time(prices(spark, folder))


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "CAST(p_partkey AS INT) AS producto_id",
        "concat_ws(' ', p_name, p_brand) AS nombre_completo",
        "p_name AS nombre",
        "p_type AS categoria",
        "concat('size ', p_size) AS subcategoria",
        "p_brand AS marca",
        "concat('size ', p_size) AS especificacion",
    )


def _suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with their nation, a table of 25 rows at every scale."""
    nation = F.broadcast(table(spark, folder, "nation"))
    return table(spark, folder, "supplier").join(nation, F.expr("s_nationkey = n_nationkey"))


def dim_store(spark: SparkSession, folder: str) -> DataFrame:
    return _suppliers(spark, folder).selectExpr(
        "CAST(s_suppkey AS INT) AS establecimiento_id",
        "s_name AS nombre",
        "s_name AS razon_social",
        "IF(s_suppkey % 7 = 0, NULL, n_name) AS cadena",
        "IF(s_suppkey % 7 = 0, 'Sin Cadena', n_name) AS cadena_normalizada",
    )


def dim_location(spark: SparkSession, folder: str) -> DataFrame:
    """Regions are a table of 5 rows at every scale."""
    region = F.broadcast(table(spark, folder, "region"))
    placed = _suppliers(spark, folder).join(region, F.expr("n_regionkey = r_regionkey"))
    return placed.selectExpr(
        "CAST(s_suppkey AS INT) AS establecimiento_id",
        "r_name AS departamento",
        "n_name AS ciudad",
        "concat('Dir ', s_suppkey) AS direccion",
        "IF(s_suppkey % 5 = 0, 'Sin Barrio', concat('Barrio ', s_suppkey % 3)) AS barrio",
        "CAST(s_suppkey AS INT) AS ubicacion_id",
    )


def mart(spark: SparkSession, folder: str) -> Mart:
    return Mart(
        prices(spark, folder),
        Dimension(partial(dim_product, spark, folder), "producto_id"),
        Dimension(partial(dim_store, spark, folder), "establecimiento_id"),
        Dimension(partial(dim_location, spark, folder), "establecimiento_id"),
        PRICE_SCALE,
    )
