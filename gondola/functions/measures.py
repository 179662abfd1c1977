"""Arithmetic of the price metrics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def units(value: Column, scale: int | None) -> Column:
    """The value in whole units of its last decimal, or as it is without a known scale.

    A value with more decimals than the scale, or too large for exact units, is an error: it
    is never rounded in silence, whether the session is in ANSI mode or not."""
    if scale is None:
        return value
    scaled = value * 10**scale
    near = F.abs(scaled - F.rint(scaled)) <= 1e-4 + F.abs(scaled) * 1e-12
    exact = near & (F.abs(scaled) < 2.0**53)
    return F.when(value.isNull() | exact, F.floor(scaled + 0.5)).otherwise(
        F.raise_error(F.format_string("price %s does not fit a scale of %s", value.cast("string"), F.lit(str(scale)))).cast("bigint")
    )


def total(value: Column) -> Column:
    """Aggregate sum that fails where a 64-bit sum would wrap around.

    With two decimals and prices up to 100,000 a single group may hold 900 billion rows."""
    added = F.try_sum(value)
    return F.when(added.isNull() & (F.count(value) > 0), F.raise_error(F.lit("a sum of prices does not fit 64 bits")).cast("bigint")).otherwise(added)


def money(total: Column, scale: int | None) -> Column:
    """A total of units back as an amount."""
    return total if scale is None else total / 10**scale


def mean(value: Column, scale: int | None) -> Column:
    """Aggregate mean; with a scale the sum is exact and independent of row order."""
    return money(total(units(value, scale)), scale) / F.count(value)


def pct_change(now: Column, before: Column) -> Column:
    """Change in percent; null without a previous value or when that value is 0."""
    return F.try_divide(now - before, before) * 100


def dispersion(low: Column, high: Column, mean: Column) -> Column:
    return F.try_divide(high - low, mean)


def share_pct(part: Column, whole: Column) -> Column:
    """part/whole in percent, 0 for an empty whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def dispersion_band(index: Column) -> Column:
    """Fixed thresholds: below 0.3 low, up to 1.0 medium, above 1.0 high."""
    return F.when(index < 0.3, "baja").when(index <= 1.0, "media").when(index > 1.0, "alta")


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin of value in [low, high]; the last bin includes its upper edge."""
    step = (high - low) / bins
    return F.least(
        F.coalesce(F.floor(F.try_divide(value - low, step)), F.lit(0).cast("bigint")),
        F.lit(bins - 1).cast("bigint"),
    ).cast("int")


def is_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)
