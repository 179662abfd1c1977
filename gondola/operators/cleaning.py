"""Raw-zone operators: text rows of the three source files to typed, valid rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gondola.functions import parsing


def clean_prices(text: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed price observations with a positive finite price and both ids.

    Duplicates stay. An unreadable date or offer flag becomes null and the row stays;
    rows without a date leave only when the fact table is built. `carry` names other columns to keep.
    """
    typed = text.select(
        parsing.as_date(F.col("Fecha")).alias("fecha"),
        F.col("Presentacion_Producto").cast("string").alias("producto_id"),
        F.col("Establecimiento").cast("string").alias("establecimiento_id"),
        parsing.as_price(F.col("Precio")).alias("precio"),
        parsing.as_int(F.col("Oferta")).alias("oferta"),
        *carry,
    )
    return typed.filter("precio > 0 AND producto_id IS NOT NULL AND establecimiento_id IS NOT NULL")


def clean_products(text: DataFrame) -> DataFrame:
    """Product catalogue under plain names; every other file column is carried along."""
    named = text.withColumnRenamed("id.producto", "producto_id").withColumns(
        {"categoria": F.col("producto"), "subcategoria": F.col("especificacion")}
    )
    return one_row_per_key(named, "producto_id")


def clean_stores(text: DataFrame) -> DataFrame:
    """Store catalogue under plain names; every other file column is carried along."""
    named = text.withColumnsRenamed(
        {
            "id.establecimientos": "establecimiento_id",
            "razon.social": "razon_social",
            "nombre.sucursal": "nombre",
        }
    )
    return one_row_per_key(named, "establecimiento_id")


def one_row_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The smallest row of every key, comparing the other columns from left to right with
    nulls first. An aggregate, so copies of a frequent key collapse before the shuffle; a
    null key counts as one key."""
    rest = [F.col(f"`{c}`") for c in rows.columns if c != key]
    kept = rows.groupBy(key).agg(F.min(F.struct(*rest)).alias("fila"))
    return kept.select(key, "fila.*").select(*[F.col(f"`{c}`") for c in rows.columns])
