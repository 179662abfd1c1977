"""Data-quality checks, declared as data and evaluated as DataFrames.

All null, range and domain checks of a table share one aggregate over it, and all of its
foreign-key checks share another. Duplicate and foreign-key checks count per key first, so a
key repeated in a third of the table reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gondola.functions import measures


@dataclass(frozen=True)
class NotNull:
    """No nulls in the columns; columns the table lacks are skipped."""

    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class InRange:
    """Inclusive bounds, each optional. With a bound, null counts as out of range."""

    table: str
    column: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class InDomain:
    """Values from a fixed set; null counts as invalid."""

    table: str
    column: str
    allowed: tuple


@dataclass(frozen=True)
class Unique:
    """No surplus copies of the key (null is a value); without keys, of the whole row."""

    table: str
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class ForeignKey:
    """Every row of the table finds its key in the parent; a null key is an orphan."""

    table: str
    column: str
    parent: str
    parent_key: str


# The checks of the star schema.
STAR_CHECKS = (
    NotNull("fact_precios", ("fecha_id", "producto_id", "establecimiento_id", "ubicacion_id", "precio")),
    NotNull("dim_tiempo", ("fecha_id", "fecha", "anio", "mes", "dia")),
    NotNull("dim_producto", ("producto_id", "nombre")),
    NotNull("dim_establecimiento", ("establecimiento_id", "nombre")),
    NotNull("dim_ubicacion", ("ubicacion_id", "establecimiento_id")),
    ForeignKey("fact_precios", "fecha_id", "dim_tiempo", "fecha_id"),
    ForeignKey("fact_precios", "producto_id", "dim_producto", "producto_id"),
    ForeignKey("fact_precios", "establecimiento_id", "dim_establecimiento", "establecimiento_id"),
    ForeignKey("fact_precios", "ubicacion_id", "dim_ubicacion", "ubicacion_id"),
    Unique("dim_tiempo", ("fecha_id",)),
    Unique("dim_producto", ("producto_id",)),
    Unique("dim_establecimiento", ("establecimiento_id",)),
    Unique("dim_ubicacion", ("ubicacion_id",)),
    InRange("fact_precios", "precio", low=0.01),
    InRange("dim_tiempo", "anio", 2020, 2030),
    InRange("dim_tiempo", "mes", 1, 12),
    InRange("dim_tiempo", "dia", 1, 31),
    InDomain("fact_precios", "oferta", (0, 1)),
    InDomain("dim_tiempo", "dia_semana", (1, 2, 3, 4, 5, 6, 7)),
    InDomain("dim_tiempo", "trimestre", (1, 2, 3, 4)),
)

# The check_type texts of the report.
KIND = {
    NotNull: "null_values",
    ForeignKey: "referential_integrity",
    Unique: "duplicates",
    InRange: "range_validation",
    InDomain: "consistency",
}

# Columns of an evaluation.
RESULT = ("tabla", "check_type", "columna", "total_rows", "failed_rows", "failed_pct", "passed")


def evaluate(tables: dict[str, DataFrame], checks: Sequence) -> DataFrame:
    """One row per check, null checks giving one per column (see RESULT)."""
    parts = []
    for name in dict.fromkeys(c.table for c in checks):
        scanned = [c for c in checks if c.table == name and not isinstance(c, (Unique, ForeignKey))]
        if scanned:
            parts.append(_scan(tables[name], name, scanned))
    for name in dict.fromkeys(c.table for c in checks if isinstance(c, ForeignKey)):
        own = [c for c in checks if isinstance(c, ForeignKey) and c.table == name]
        parts.append(_orphans(tables[name], tables, own))
    parts += [_surplus(tables[c.table], c) for c in checks if isinstance(c, Unique)]
    return _judged(reduce(DataFrame.unionAll, parts))


def _judged(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "failed_pct": measures.share_pct(F.col("failed_rows"), F.col("total_rows")),
            "passed": F.col("failed_rows") == 0,
        }
    )


def _scan(rows: DataFrame, table: str, checks: Sequence) -> DataFrame:
    """All single-row predicates of a table in one pass, turned into rows afterwards."""
    predicates: list[tuple[str, str, Column]] = []
    for check in checks:
        kind = KIND[type(check)]
        if isinstance(check, NotNull):
            present = [c for c in check.columns if c in rows.columns]
            predicates += [(kind, c, F.col(f"`{c}`").isNull()) for c in present]
            if not present:
                predicates.append((kind, "", F.lit(False)))
        else:
            predicates.append((kind, check.column, ~F.coalesce(_valid(check), F.lit(False))))
    failures = [F.count_if(p).alias(f"c{i}") for i, (_, _, p) in enumerate(predicates)]
    lines = ", ".join(f"'{kind}', '{column}', c{i}" for i, (kind, column, _) in enumerate(predicates))
    return rows.agg(F.count("*").alias("total_rows"), *failures).selectExpr(
        f"'{table}' AS tabla",
        f"stack({len(predicates)}, {lines}) AS (check_type, columna, failed_rows)",
        "total_rows",
    ).select(*RESULT[:5])


def _valid(check: InRange | InDomain) -> Column:
    value = F.col(check.column)
    if isinstance(check, InDomain):
        return value.isin(list(check.allowed))
    bounds = [value >= check.low] if check.low is not None else []
    bounds += [value <= check.high] if check.high is not None else []
    return reduce(Column.__and__, bounds, F.lit(True))


def _surplus(rows: DataFrame, check: Unique) -> DataFrame:
    keys = list(check.keys) or rows.columns
    copies = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count("*").alias("copies"))
    return _counted(copies, "copies", "copies - 1", check.table, check, ",".join(check.keys))


def _orphans(rows: DataFrame, tables: dict[str, DataFrame], checks: Sequence[ForeignKey]) -> DataFrame:
    """All foreign keys of a table from one scan: uses are counted per check and key value, and
    only these counts meet the parents' keys. Keys are compared as text; null is an orphan."""
    keys = [F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("clave")) for i, c in enumerate(checks)]
    uses = rows.select(F.inline(F.array(*keys))).groupBy("i", "clave").agg(F.count("*").alias("usos"))
    parents = [
        tables[c.parent].select(F.lit(i).alias("i"), F.col(c.parent_key).cast("string").alias("clave"), F.lit(True).alias("hay"))
        for i, c in enumerate(checks)
    ]
    known = reduce(DataFrame.unionAll, parents).distinct()
    sums = uses.join(known, ["i", "clave"], "left").agg(
        *[F.coalesce(F.sum(F.when(F.col("i") == i, F.col("usos"))), F.lit(0)).alias(f"t{i}") for i in range(len(checks))],
        *[F.coalesce(F.sum(F.when((F.col("i") == i) & F.col("hay").isNull(), F.col("usos"))), F.lit(0)).alias(f"f{i}") for i in range(len(checks))],
    )
    lines = ", ".join(f"'{c.table} -> {c.parent}', '{c.column}', t{i}, f{i}" for i, c in enumerate(checks))
    told = sums.selectExpr(f"stack({len(checks)}, {lines}) AS (tabla, columna, total_rows, failed_rows)")
    return told.select("tabla", F.lit(KIND[ForeignKey]).alias("check_type"), "columna", "total_rows", "failed_rows")


def _counted(groups: DataFrame, total: str, failed: str, table: str, check, column: str) -> DataFrame:
    """Total and failing rows over per-key counts."""
    sums = groups.selectExpr(
        f"coalesce(sum({total}), 0) AS total_rows", f"coalesce(sum({failed}), 0) AS failed_rows"
    )
    return sums.selectExpr(
        f"'{table}' AS tabla", f"'{KIND[type(check)]}' AS check_type", f"'{column}' AS columna",
        "total_rows", "failed_rows",
    )


def report(results: DataFrame) -> DataFrame:
    """One row per check: the columns of a null check count as a single one."""
    grouping = F.when(F.col("check_type") != KIND[NotNull], F.col("columna"))
    joined = results.groupBy("tabla", "check_type", grouping.alias("columna")).agg(
        F.sum("failed_rows").alias("failed_rows"),
        F.max("total_rows").alias("total_rows"),
        F.bool_and("passed").alias("passed"),
    )
    subject = F.concat_ws(".", "tabla", "columna")
    return joined.select(
        F.col("tabla").alias("table"),
        "check_type",
        "passed",
        F.format_string("%s %s: %d of %d", subject, "check_type", "failed_rows", "total_rows").alias("message"),
    )


def summary(checks: DataFrame) -> DataFrame:
    """Totals over a report; an empty report has passed."""
    total, passed = F.count("*"), F.count_if(F.col("passed"))
    return checks.agg(
        total.alias("total_checks"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        measures.share_pct(passed, total).alias("pass_rate"),
        (total == passed).alias("all_passed"),
    )


def null_profile(rows: DataFrame, table: str) -> DataFrame:
    """Null count and share of every column, in one pass."""
    return _judged(_scan(rows, table, [NotNull(table, tuple(rows.columns))])).select(
        "tabla", "columna", "total_rows",
        F.col("failed_rows").alias("nulos"), F.col("failed_pct").alias("porcentaje"),
    )


def duplicate_profile(rows: DataFrame, table: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows, distinct rows (or keys) and surplus copies."""
    return _judged(_surplus(rows, Unique(table, keys))).select(
        "tabla", "total_rows",
        (F.col("total_rows") - F.col("failed_rows")).alias("unicos"),
        F.col("failed_rows").alias("duplicados"), F.col("failed_pct").alias("porcentaje"),
    )


def orphan_keys(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """The distinct key values, null included, that the parent does not have."""
    return rows.select(key).distinct().join(parent.select(key), key, "left_anti")
