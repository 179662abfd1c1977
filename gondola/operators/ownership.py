"""Which source owns an observation that several of them bring."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gondola.functions import parsing

#: When the source file of a row was last written, and its name.
WRITTEN, FILE = "fuente_en", "archivo"
KEY = ("_dia", "_producto", "_establecimiento")


def _keyed(rows: DataFrame) -> DataFrame:
    """The rows with their observation key; ids written like 12.0 are the id 12."""
    ids = (F.coalesce(parsing.as_int(F.col(c)).cast("string"), F.col(c)) for c in ("producto_id", "establecimiento_id"))
    return rows.withColumns(dict(zip(KEY, (F.col("fecha"), *ids))))


def current(loaded: DataFrame, arrived: DataFrame) -> DataFrame:
    """The rows that count of a batch load and of files that arrived one by one.

    An observation, that is a day, product and store, belongs to the source that was written
    last: a daily file that a fuller load has taken in is superseded, and one that was
    written after the load corrects it, as a later daily file corrects an earlier one (of equal
    times the load's rows stay, then the larger file name's). All rows of the owner stay, so equal
    rows of one source are all kept; the load counts as one source. Rows without a day have no
    key: nothing supersedes them.

    `loaded` has the columns of raw prices and WRITTEN, `arrived` also FILE. Only rows of days
    that some file brings meet the keys in a shuffle; the days are broadcast, of which the
    calendar from year 1 to 9999 has under four million.
    """
    columns = [c for c in loaded.columns if c != WRITTEN]
    arrived = _keyed(arrived.select(*columns, WRITTEN, FILE))
    dated = arrived.filter("fecha IS NOT NULL")
    last = dated.groupBy(*KEY).agg(F.max(F.struct(WRITTEN, FILE)).alias("_ultimo"))
    days = F.broadcast(dated.select("fecha").distinct())
    same_days = _keyed(loaded.join(days, "fecha", "left_semi"))
    corrected = same_days.join(last, list(KEY), "left").filter(
        F.col("_ultimo").isNull() | (F.col(f"_ultimo.{WRITTEN}") <= F.col(WRITTEN))
    )
    held = same_days.groupBy(*KEY).agg(F.max(WRITTEN).alias("_cargado"))
    newest = dated.join(last, list(KEY)).filter(F.struct(WRITTEN, FILE) == F.col("_ultimo"))
    news = newest.join(held, list(KEY), "left").filter(F.col("_cargado").isNull() | (F.col("_cargado") < F.col(WRITTEN)))
    rest = loaded.join(days, "fecha", "left_anti")
    undated = arrived.filter("fecha IS NULL")
    parts = [rest, corrected, news, undated]
    return parts[0].select(columns).unionAll(parts[1].select(columns)).unionAll(parts[2].select(columns)).unionAll(parts[3].select(columns))


def account(loaded: DataFrame, arrived: DataFrame, read: DataFrame) -> DataFrame:
    """Per arrived file: rows read, rows the cleaning kept, those that count, and those that another
    source supersedes. `read` has FILE and `leidas`."""
    arrived = arrived.select(*[c for c in loaded.columns if c != WRITTEN], WRITTEN, FILE)
    marked = current(loaded.withColumn("_de", F.lit(None).cast("string")), arrived.withColumn("_de", F.col(FILE)))
    counting = marked.filter("_de IS NOT NULL").groupBy(F.col("_de").alias(FILE)).agg(F.count("*").alias("vigentes"))
    kept = arrived.groupBy(FILE).agg(F.count("*").alias("validas"))
    of = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (
        read.groupBy(FILE).agg(F.sum("leidas").alias("leidas"))
        .join(kept, FILE, "left").join(counting, FILE, "left")
        .select(FILE, "leidas", of("validas"), of("vigentes"), (F.coalesce("validas", F.lit(0)) - F.coalesce("vigentes", F.lit(0))).alias("reemplazadas"))
    )
