"""The price fact table and the mart that bundles it with its dimensions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from gondola.functions import calendar, parsing
from gondola.operators import scale, skew


class Dimension:
    """A dimension under its key. The frame is built and its size measured on first use,
    so a metric pays only for the dimensions it touches."""

    def __init__(self, build: Callable[[], DataFrame], key: str) -> None:
        self._build = build
        self.key = key

    @cached_property
    def frame(self) -> DataFrame:
        return self._build()

    @cached_property
    def size(self) -> tuple[int, int]:
        return scale.measure(self.frame)

    @property
    def rows(self) -> int:
        return self.size[0]

    @property
    def small(self) -> bool:
        return self.size[1] <= scale.BROADCAST_BYTES

    def side(self, *columns) -> DataFrame:
        """Key and chosen columns as a join side: broadcast when measured small enough,
        otherwise left to a shuffle join."""
        narrow = self.frame.select(self.key, *columns)
        return F.broadcast(narrow) if self.small else narrow


    def match(self, rows: DataFrame, *columns, how: str = "inner") -> DataFrame:
        """rows joined to key and chosen columns: by broadcast if measured small enough, otherwise by a
        shuffle that splits keys measured hot."""
        side = self.side(*columns)
        return rows.join(side, self.key, how) if self.small else skew.join(rows, side, self.key, how)


@dataclass(frozen=True)
class Mart:
    """Fact and dimensions. price_scale is the number of decimals prices are known to
    have: with it sums run on whole units, so they do not depend on the order in which
    tasks finish; without it prices are summed as doubles."""

    fact: DataFrame
    products: Dimension
    stores: Dimension
    locations: Dimension
    price_scale: int | None = None


def fact_prices(
    prices: DataFrame,
    products: Dimension,
    stores: Dimension,
    locations: Dimension,
    times: Dimension | None = None,
) -> DataFrame:
    """Price observations with all four surrogate keys.

    Observations of unknown products or stores and those without a date are left out. The
    product join adds nothing but existence, hence a semi join. Stores and locations have the
    same key and are put together first, so that the observations are joined to them once; each
    join of a dimension too large to broadcast thus has a shuffle of its own, in which the
    keys that a count sketch finds hot are split. The date key is computed from the date; pass `times` to
    also restrict the fact to a given calendar.
    """
    typed = prices.withColumns(
        {
            "producto_id": parsing.as_int(F.col("producto_id")),
            "establecimiento_id": parsing.as_int(F.col("establecimiento_id")),
            "fecha_id": calendar.date_key(F.col("fecha")),
        }
    ).filter("fecha IS NOT NULL")
    places = locations.side("ubicacion_id").join(stores.side(), "establecimiento_id", "left_semi")
    if times is not None:
        typed = typed.join(times.side(), "fecha", "left_semi")
    known = products.match(typed, how="left_semi")
    placed = known.join(F.broadcast(places), "establecimiento_id") if locations.small else skew.join(known, places, "establecimiento_id")
    return placed.select(
        "fecha_id", "producto_id", "establecimiento_id", "ubicacion_id", "precio", "oferta", "fecha"
    )
