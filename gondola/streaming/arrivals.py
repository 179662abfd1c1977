"""Daily price files picked up as they arrive, instead of re-reading all of them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.operators import ownership
from gondola.operators.cleaning import clean_prices
from gondola.operators.ownership import FILE, WRITTEN
from gondola.sources import csvfiles
from gondola.sources.lake import Lake

TABLE = "precios_arribos"
READ = "precios_arribos_leidos"


def take_new_files(spark: SparkSession, base: str, pattern: str, columns: list[str]) -> list[tuple[int, int]]:
    """Clean the landing price files matching `pattern` that appeared since the last call.

    `columns` is the header of the files in order. The stream's checkpoint, kept in the
    lake, remembers which files were taken. Each batch owns one folder, named after the
    stream's lasting id and its number, and replaces it when it is run again after a failure.
    A stream that lost its state has a new id and leaves older batches alone; rows carry the
    name and time of their file, of which raw_prices takes one batch only. The rows read of each
    file are counted next to it, so that the audit can tell how many the cleaning refused.

    Returns the (year, month) pairs that the new files bring rows of: what an incremental run of the
    other jobs has to do again.
    """
    lake = Lake(spark, base)
    months: set[tuple[int, int]] = set()

    def store(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        lot = f"lote={stream}-{number}"
        read = batch.groupBy(FILE).agg(F.count("*").alias("leidas"))
        read.write.mode("overwrite").parquet(f"{lake.path('raw', READ)}/{lot}")
        clean_prices(batch, (FILE, WRITTEN)).write.mode("overwrite").parquet(f"{lake.path('raw', TABLE)}/{lot}")
        stored = spark.read.parquet(f"{lake.path('raw', TABLE)}/{lot}").filter("fecha IS NOT NULL")
        months.update((r.a, r.m) for r in stored.select(F.year("fecha").alias("a"), F.month("fecha").alias("m")).distinct().collect())

    arriving = (
        spark.readStream.options(**csvfiles.PRICES.options, header="true", enforceSchema="false")
        .schema(", ".join(f"`{c}` string" for c in columns))
        .csv(f"{lake.path('landing')}/{pattern}")
    )
    query = (
        arriving.withColumns({FILE: F.col("_metadata.file_path"), WRITTEN: F.col("_metadata.file_modification_time")})
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", lake.path("raw", f"_{TABLE}_estado"))
        .foreachBatch(store)
        .start()
    )
    query.awaitTermination()
    return sorted(months)


def _stored(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    try:
        return Lake(spark, base).read("raw", table)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _timed(rows: DataFrame) -> DataFrame:
    """The rows with the time of their source; one that was not recorded is that of the stored file."""
    stored = F.col("_metadata.file_modification_time")
    return rows.withColumn(WRITTEN, F.coalesce(WRITTEN, stored) if WRITTEN in rows.columns else stored)


def _sources(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame | None]:
    """The batch load, and each arrived file once."""
    loaded, arrived = _timed(Lake(spark, base).read("raw", "precios")), _stored(spark, base, TABLE)
    if arrived is None:
        return loaded, None
    arrived = _timed(arrived)
    one = arrived.groupBy(FILE).agg(F.min("lote").alias("lote"))
    return loaded, arrived.join(one, [FILE, "lote"], "left_semi")


def raw_prices(spark: SparkSession, base: str) -> DataFrame:
    """All raw prices: the batch load and, where there are any, arrivals. An observation that
    both bring belongs to the source whose file was written last (see operators/ownership.py), so a day
    that came as a daily file first and is part of a fuller price file later is not counted
    twice, and a daily file that is written later adds to the load or corrects it."""
    loaded, arrived = _sources(spark, base)
    return loaded.drop(WRITTEN) if arrived is None else ownership.current(loaded, arrived)


def audit(spark: SparkSession, base: str) -> DataFrame:
    """Per arrived file: rows read, valid, counting and superseded; stored as raw/_auditoria_arribos."""
    loaded, arrived = _sources(spark, base)
    if arrived is None:
        return spark.createDataFrame([], "archivo string, leidas bigint, validas bigint, vigentes bigint, reemplazadas bigint")
    read = _stored(spark, base, READ)
    once = read.join(read.groupBy(FILE).agg(F.min("lote").alias("lote")), [FILE, "lote"], "left_semi")
    return Lake(spark, base).replace("raw", "_auditoria_arribos", ownership.account(loaded, arrived, once))
