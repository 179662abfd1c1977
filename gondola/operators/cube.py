"""Mergeable price states and their roll-up.

A state row stands for any number of observations: n, their total, lowest and highest
price. Observations are states with n = 1, and states of a fine grain roll up to any
coarser one, so a stored monthly cube and the fact itself feed the same metrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gondola.functions import measures
from gondola.operators.facts import Dimension, Mart

STATE = ("n", "total", "bajo", "alto")


def observations(mart: Mart) -> DataFrame:
    """The fact as states. The calendar period is the stored partition's, or else the date's."""
    price = F.col("precio")
    stored = "anio" in mart.fact.columns and "mes" in mart.fact.columns
    return mart.fact.select(
        "producto_id",
        "establecimiento_id",
        "fecha",
        F.col("anio") if stored else F.year("fecha").alias("anio"),
        F.col("mes") if stored else F.month("fecha").alias("mes"),
        F.lit(1).cast("bigint").alias("n"),
        measures.units(price, mart.price_scale).alias("total"),
        price.alias("bajo"),
        price.alias("alto"),
    )


def roll_up(states: DataFrame, *keys: str) -> DataFrame:
    return states.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        measures.total(F.col("total")).alias("total"),
        F.min("bajo").alias("bajo"),
        F.max("alto").alias("alto"),
    )


def attach(states: DataFrame, dimension: Dimension, keep: list[str], **columns: str) -> DataFrame:
    """Add dimension columns (new name = dimension column) to states whose other keys are
    `keep`.

    A dimension measured small is broadcast to the states as they are. A larger one meets
    states that were first rolled up, so that even a product behind a third of all
    observations arrives at the shuffle join as one row per remaining key combination.
    """
    side = dimension.side(*[F.col(old).alias(new) for new, old in columns.items()])
    keys = list(dict.fromkeys([*keep, dimension.key]))
    ready = states.select(*keys, *STATE) if dimension.small else roll_up(states, *keys)
    return ready.join(side, dimension.key)


def priced(states: DataFrame, price_scale: int | None, *keys: str) -> DataFrame:
    """States as lowest, highest and average price with the number of observations."""
    return states.select(
        *keys,
        F.col("n").alias("num_observaciones"),
        F.col("bajo").alias("precio_minimo"),
        F.col("alto").alias("precio_maximo"),
        (measures.money(F.col("total"), price_scale) / F.col("n")).alias("precio_promedio"),
    )


def monthly_cube(mart: Mart) -> DataFrame:
    """States per product, store and month: one pass over the fact from which all monthly
    metrics of both grains can be derived."""
    return roll_up(observations(mart), "producto_id", "establecimiento_id", "anio", "mes")


def by_name_month(mart: Mart, states: DataFrame | None = None) -> DataFrame:
    """Monthly prices per product name, pooling the presentations that share it."""
    states = observations(mart) if states is None else states
    named = attach(states, mart.products, ["anio", "mes"], producto="nombre")
    keys = ("producto", "anio", "mes")
    return priced(roll_up(named, *keys), mart.price_scale, *keys)


def by_product_month(mart: Mart, states: DataFrame | None = None) -> DataFrame:
    """Monthly prices per product id. The name is looked up after the aggregation."""
    states = observations(mart) if states is None else states
    keys = ("producto_id", "anio", "mes")
    named = roll_up(states, *keys).join(
        mart.products.side(F.col("nombre").alias("producto_nombre")), "producto_id"
    )
    return priced(named, mart.price_scale, "producto_id", "producto_nombre", "anio", "mes")


def by_product_day(mart: Mart) -> DataFrame:
    """Daily prices per product id."""
    keys = ("producto_id", "fecha")
    named = roll_up(observations(mart), *keys).join(
        mart.products.side(F.col("nombre").alias("producto_nombre")), "producto_id"
    )
    return priced(named, mart.price_scale, "producto_id", "producto_nombre", "fecha")
