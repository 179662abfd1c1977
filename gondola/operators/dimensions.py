"""The four dimensions of the star schema.

Fixed values: column names and the two default texts are those of the published schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gondola.functions import calendar, parsing
from gondola.operators.cleaning import one_row_per_key


def dim_time(prices: DataFrame) -> DataFrame:
    """One row per date that occurs in the prices; rows without a date give no entry."""
    dates = prices.select("fecha").filter(F.col("fecha").isNotNull()).distinct()
    return dates.withColumns(calendar.attributes(F.col("fecha")))


def dim_product(products: DataFrame) -> DataFrame:
    """nombre is the generic product, so several presentations share it."""
    return one_row_per_key(
        products.select(
            parsing.as_int(F.col("producto_id")).alias("producto_id"),
            F.col("nombre").alias("nombre_completo"),
            F.col("producto").alias("nombre"),
            "categoria",
            "subcategoria",
            "marca",
            "especificacion",
        ),
        "producto_id",
    )


def dim_store(stores: DataFrame) -> DataFrame:
    return one_row_per_key(
        stores.select(
            parsing.as_int(F.col("establecimiento_id")).alias("establecimiento_id"),
            "nombre",
            "razon_social",
            "cadena",
            F.coalesce("cadena", F.lit("Sin Cadena")).alias("cadena_normalizada"),
        ),
        "establecimiento_id",
    )


def dim_location(stores: DataFrame) -> DataFrame:
    """One location per store, under the store's own id."""
    places = stores.select(
        parsing.as_int(F.col("establecimiento_id")).alias("establecimiento_id"),
        F.col("depto").alias("departamento"),
        "ciudad",
        "direccion",
        F.coalesce("barrio", F.lit("Sin Barrio")).alias("barrio"),
    )
    return one_row_per_key(places, "establecimiento_id").withColumn("ubicacion_id", F.col("establecimiento_id"))


