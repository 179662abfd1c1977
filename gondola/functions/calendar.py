"""Calendar attributes. All of them depend on the date alone, so a fact row that
carries its date never needs a join to obtain one."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(day: Column) -> Column:
    """yyyymmdd as an int; plain integer arithmetic stays in generated code."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def attributes(day: Column) -> dict[str, Column]:
    """Attributes of the time dimension. The week is the ISO week while the year is
    the calendar year, so 2024-12-30 is week 1 of 2024."""
    return {
        "fecha_id": date_key(day),
        "anio": F.year(day),
        "mes": F.month(day),
        "dia": F.dayofmonth(day),
        "trimestre": F.quarter(day),
        "dia_semana": F.dayofweek(day),
        "semana_anio": F.weekofyear(day),
        "nombre_mes": F.date_format(day, "MMMM"),
        "nombre_dia": F.date_format(day, "EEEE"),
    }


def period_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def period_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)
