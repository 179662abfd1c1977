"""The three delimited source files: formats, readers, header contract, ingest audit."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class CsvFile:
    """Format of a source file and the columns it must have."""

    name: str
    sep: str
    encoding: str
    required: tuple[str, ...]

    @property
    def options(self) -> dict[str, str]:
        return {"sep": self.sep, "encoding": self.encoding, "quote": '"', "escape": '"'}


# Formats and headers of the published files.
PRICES = CsvFile(
    "precios", ",", "UTF-8", ("Fecha", "Precio", "Presentacion_Producto", "Establecimiento", "Oferta")
)
PRODUCTS = CsvFile(
    "productos", ";", "ISO-8859-1", ("id.producto", "producto", "marca", "especificacion", "nombre")
)
STORES = CsvFile(
    "establecimientos", ";", "ISO-8859-1",
    ("id.establecimientos", "razon.social", "nombre.sucursal", "direccion", "ciudad", "depto", "cadena", "barrio"),
)
FILES = (PRICES, PRODUCTS, STORES)

MALFORMED = "_malformada"


def read(spark: SparkSession, file: CsvFile, path: str | list[str]) -> DataFrame:
    """All columns of the file, as text, under their header names.

    Files read together must have the same header: one that has other names, or the same in
    another order, fails when it is read instead of being taken by position."""
    return spark.read.options(**file.options, header="true", enforceSchema="false").csv(path)


def read_marked(spark: SparkSession, file: CsvFile, path: str) -> DataFrame:
    """As read, with the raw text of rows that have too few or too many fields in MALFORMED."""
    columns = read(spark, file, path).columns
    schema = ", ".join(f"`{c}` string" for c in [*columns, MALFORMED])
    options = {**file.options, "header": "true", "enforceSchema": "false", "columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    return spark.read.options(**options).schema(schema).csv(path)


def with_file_year(rows: DataFrame, path: Column) -> DataFrame:
    """Year of a yearly price file, from a path like landing/2024/precios_2024.csv. Rows of
    files whose folder and name disagree, or that are not named so, are not yearly data."""
    pattern = r"/([0-9]+)/precios_([0-9]+)\.csv(?:/[^/]*)?$"
    folder, name = F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)
    return rows.withColumn("anio_archivo", F.when(folder == name, folder.try_cast("int"))).filter(
        "anio_archivo IS NOT NULL"
    )


def read_yearly_prices(spark: SparkSession, landing: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """Every landing/<year>/precios_<year>.csv with its year; years without a file are
    simply absent, and without any there are no rows. Files of the same header are one scan, whose
    rows get their year from the file's path; scans are put together by column name. A required
    column that a file lacks is an error. `carry` adds columns made from a file's metadata."""
    carry = carry or {}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in yearly_paths(spark, landing):
        rows = read(spark, PRICES, path)
        if gaps := missing_columns(PRICES, rows):
            raise ValueError(f"{path} lacks {','.join(gaps)}")
        by_header.setdefault(tuple(rows.columns), []).append(path)
    scans = [
        with_file_year(read(spark, PRICES, paths).withColumns({**carry, "_ruta": F.col("_metadata.file_path")}), F.col("_ruta")).drop("_ruta")
        for paths in by_header.values()
    ]
    if not scans:
        empty = ", ".join(f"`{c}` string" for c in PRICES.required)
        return spark.createDataFrame([], f"{empty}, anio_archivo int").withColumns({c: F.lit(None).cast("timestamp") for c in carry})
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def yearly_paths(spark: SparkSession, landing: str) -> list[str]:
    """The yearly price files (or folders of part files) there are; a listing, no contents."""
    found = []
    for pattern in (f"{landing}/[0-9]*/precios_[0-9]*.csv", f"{landing}/[0-9]*/precios_[0-9]*.csv/part-*"):
        try:
            listed = spark.read.format("binaryFile").load(pattern).select("path")
            found += [re.sub(r"(\.csv)/part-[^/]*$", r"\1", r.path) for r in listed.collect()]
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
    named = re.compile(r"/([0-9]+)/precios_([0-9]+)\.csv$")  # a folder and a name that disagree are no yearly file
    return sorted({path for path in found if (years := named.search(path)) and years[1] == years[2]})


def missing_columns(file: CsvFile, rows: DataFrame | None) -> list[str]:
    """Required columns that the file, or its absence, leaves open; reads headers only."""
    return [c for c in file.required if rows is None or c not in rows.columns]


def contract(files: dict[CsvFile, DataFrame | None], spark: SparkSession, count: bool = True) -> DataFrame:
    """One row per file: whether it was found, required columns it lacks, data rows. Without
    `count` only headers are looked at, and filas is null."""
    parts = []
    for file, rows in files.items():
        missing = missing_columns(file, rows)
        counted = spark.range(0) if rows is None else rows
        filas = counted.agg(F.count("*").alias("filas")) if count else spark.range(1).select(F.lit(None).cast("bigint").alias("filas"))
        parts.append(
            filas.select(
                F.lit(file.name).alias("archivo"),
                F.lit(rows is not None).alias("existe"),
                F.lit(",".join(missing)).alias("columnas_faltantes"),
                "filas",
                F.lit(not missing).alias("passed"),
            )
        )
    return reduce(DataFrame.unionAll, parts)


def find(spark: SparkSession, folder: str) -> dict[CsvFile, DataFrame | None]:
    """The three files of a folder; None for a file that is not there."""
    found: dict[CsvFile, DataFrame | None] = {}
    for file in FILES:
        try:
            found[file] = read(spark, file, f"{folder}/{file.name}.csv")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            found[file] = None
    return found


def audit(read_rows: dict[str, DataFrame], kept_rows: dict[str, DataFrame]) -> DataFrame:
    """Per file: rows read, rows kept by cleaning, kept rows without a date."""
    parts = []
    for name, rows in read_rows.items():
        kept = kept_rows[name]
        dateless = F.count_if(F.col("fecha").isNull()) if "fecha" in kept.columns else F.lit(0).cast("bigint")
        parts.append(
            kept.agg(F.count("*").alias("filas_validas"), dateless.alias("fechas_nulas")).select(
                F.lit(name).alias("archivo"),
                rows.agg(F.count("*")).scalar().alias("filas_leidas"),
                "filas_validas",
                "fechas_nulas",
            )
        )
    return reduce(DataFrame.unionAll, parts)
