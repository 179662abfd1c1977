"""Text to typed values. Nothing here raises on bad input: what cannot be read is null.

The shape of a field is tested before it is parsed. A failed parse costs an exception
inside Spark, many times the price of the test.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DATE = r"^\d{4}-\d\d-\d\d$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def as_date(text: Column) -> Column:
    """Dates are written yyyy-MM-dd."""
    return F.when(text.rlike(DATE), text.try_cast("date"))


def as_price(text: Column) -> Column:
    """A finite double; the texts NaN and Infinity do not count as prices."""
    value = text.try_cast("double")
    return F.when(text.rlike(NUMBER) & (F.abs(value) < F.lit(float("inf"))), value)


def as_int(text: Column) -> Column:
    """An integer, also when written like 1.0; null outside the int range."""
    return F.when(text.rlike(NUMBER), text.try_cast("double").try_cast("int"))
