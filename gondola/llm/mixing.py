"""Mixing sources to target weights (1), with DataFrame functions only.

Each source gets a target in words: a share of all words, dealt by weight; no source gets more than `most`
times what it has, and what is cut off there is dealt again by weight among the others. Of a source with
target t and size s every document is taken floor(t/s) times for certain. The rest is a Pareto order sample:
document i gets the random odds u/(1-u) divided by its inclusion odds p/(1-p), and documents are taken from
the smallest quotient on. Instead of a fixed number of documents the sample has a fixed number of words: it
ends at the document that brings the source nearest to its target (taken if more than half of it fits).
Thus whole documents are taken, and a source misses its target by half of one document at most.

p is the source's t/s - floor(t/s). A column `odds` (positive) multiplies a document's inclusion odds, so a
better document is likelier within its source; null or not positive counts as 1.

Finding where a source's sample ends needs no sorted source: quotients fall into 4096 ranges, the one with
the end into 4096 more, and only that one's documents are sorted, after equal ones were counted. A source
with a third of all rows is one row per range before any shuffle. u comes from the md5 of the key, so reruns
agree. Rows that agree in source, key and size draw the same u; where the sample ends among them, as many
are taken as fit, by their place in the written rows: some of them, whichever, as they are alike to the mix.

Defined results: a null text has size 0 and is taken 0 times; null is a source of its own, the last one;
an empty table gives no rows; sources without words have target 0. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gondola.llm.common import WORD, cut, small

RANGES = 4096
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From (source, size): a row per source with source_size, target, copies and rest (words to sample).

    Sources in code-point order take the weights in turn. Sorted by size over weight, the sources that end
    up at their cap come first: one of them is capped if its cap is at most its part of what is left.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int")).cast("double")
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    total = lambda c, w=every: F.coalesce(F.sum(c).over(w), F.lit(0.0))
    cap = F.col("source_size") * F.lit(float(most))
    dealt = (
        per.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("all", total("source_size") * F.lit(float(share)))
        .withColumn("left", F.col("all") - total("cap", before))
        .withColumn("heavy", total("weight") - total("weight", before))
        .withColumn("full", F.col("fill") * F.col("heavy") <= F.col("left"))
        .withColumn("taken_up", total(F.when(F.col("full"), F.col("cap"))))
        .withColumn("open", total(F.when(~F.col("full"), F.col("weight"))))
    )
    part = F.col("weight") * (F.col("all") - F.col("taken_up")) / F.col("open")
    target = F.when(F.col("full"), F.col("cap")).otherwise(part)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    return (
        dealt.withColumn("target", target)
        .withColumn("copies", copies)
        .select("source", "source_size", "target", "copies", (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"))
    )


def quotient(key: str, odds: str, seed: str) -> Column:
    """x/(1+x) of the Pareto quotient x, which keeps the order and lies in [0, 1)."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(key))), 1, 13), 16, 10).cast("double")
    u = (drawn + 0.5) / F.lit(float(2**52))
    p = F.col("rest") / F.col("source_size")
    factor = F.when(F.col(odds) > 0, F.col(odds)).otherwise(F.lit(1.0))
    x = u / (1 - u) / (p / (1 - p) * factor)
    return F.when(F.col("rest") > 0, F.least(x / (1 + x), F.lit(1 - 2.0**-53)))


def _end(ranges: DataFrame, order: str) -> DataFrame:
    """Per source, the range in which its words reach `rest`, and the words before it."""
    upto = Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    first = Window.partitionBy("source").orderBy(order)
    return (
        ranges.withColumn("after", F.sum("words").over(upto))
        .where(F.col("after") > F.col("rest"))
        .withColumn("nth", F.row_number().over(first))
        .where("nth = 1")
        .select("source", order, (F.col("after") - F.col("words")).alias("before"))
    )


def ends(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with where each source's sample ends: `floor` (all below are in), then the last unit that is in."""
    narrow = drawn.where(F.col("rest") > 0).withColumn("r1", F.floor(F.col("q") * RANGES))
    narrow = narrow.withColumn("r2", F.floor((F.col("q") * RANGES - F.col("r1")) * RANGES))
    words = F.sum("size").alias("words")
    one = small(cut(_end(narrow.groupBy("source", "rest", "r1").agg(words), "r1")))
    inside = narrow.join(one, (narrow.source.eqNullSafe(one.source)) & (narrow.r1 == one.r1)).select(
        narrow.source, "k", "size", "q", narrow.r1, "r2", (F.col("rest") - F.col("before")).alias("rest")
    )
    two = cut(_end(inside.groupBy("source", "rest", "r2").agg(words), "r2"))
    two = small(two.withColumnRenamed("before", "skip"))
    last = inside.join(two, (inside.source.eqNullSafe(two.source)) & (inside.r2 == two.r2)).select(
        inside.source, "k", "size", "q", "r1", inside.r2, (F.col("rest") - F.col("skip")).alias("rest")
    )
    units = last.groupBy("source", "rest", "r1", "r2", "q", "k", "size").agg(words)
    unit = Window.partitionBy("source").orderBy("q", "k", "size").rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("before", F.coalesce(F.sum("words").over(unit), F.lit(0)))
    fits = F.col("before") + F.col("size") / 2 <= F.col("rest")
    # of a unit of repeats, the number of rows that comes nearest
    many = F.when(F.col("size") > 0, F.round(F.col("words") / F.col("size"))).otherwise(0).cast("bigint")
    take = F.when(F.col("size") > 0, F.floor((F.col("rest") - F.col("before")) / F.col("size") + 0.5)).otherwise(0)
    found = units.withColumn("many", many).withColumn("take", F.least(take, "many")).groupBy("source").agg(
        F.min((F.col("r1") + F.col("r2") / RANGES) / RANGES).alias("floor"),
        F.max(F.when(fits, F.struct("q", "k", "size", "many", "take"))).alias("last"),
    )
    return (
        plan.alias("p").join(found.alias("f"), F.expr("p.source <=> f.source"), "left")
        .select("p.*", F.coalesce("f.floor", F.lit(0.0)).alias("floor"), "f.last")
    )


def mix(
    docs: DataFrame, *, size: Column | None = None, source: str = "source", key: str = "doc_id", odds: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = "", added: str = "mix",
) -> DataFrame:
    """The documents with a struct column `added`: size, source_size, target, copies (0 to `most`), taken (words)."""
    docs = docs.drop(added)
    sized = F.struct(
        F.col(source).alias("source"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
        (word_count() if size is None else size).alias("size"), (F.lit(1.0) if odds is None else odds).cast("double").alias("odds"),
    )
    narrow = cut(docs.select(sized.alias("s")).select("s.*"))
    plan = small(cut(targets(narrow, weights, share, most)))
    draw = lambda frame: frame.withColumn("q", quotient("k", "odds", seed))
    drawn = draw(narrow.join(plan, narrow.source.eqNullSafe(plan.source)).drop(plan.source))
    plan = small(cut(ends(drawn, plan)))
    rows = docs.select(F.struct(*docs.columns).alias("row"), sized.alias("s")).select("row", "s.*")
    rows = draw(rows.join(plan, rows.source.eqNullSafe(plan.source)).drop(plan.source))
    q, k, s = F.col("q"), F.col("k"), F.col("size")
    at_end = (q == F.col("last.q")) & (k == F.col("last.k")) & (s == F.col("last.size"))
    upto = (q < F.col("last.q")) | ((q == F.col("last.q")) & ((k < F.col("last.k")) | ((k == F.col("last.k")) & (s <= F.col("last.size")))))
    inside = (q < F.col("floor")) | F.coalesce(upto, F.lit(False))
    if not plan.where("last.take < last.many").isEmpty():
        parted = F.coalesce(at_end & (F.col("last.take") < F.col("last.many")), F.lit(False))
        shared = _placed(rows.where(parted))
        rows = rows.where(~parted).withColumn("_in", inside).unionByName(shared.withColumn("_in", F.col("_nth") < F.col("last.take")).drop("_nth"))
        inside = F.col("_in")
    more = F.when((F.col("rest") > 0) & inside, 1).otherwise(0)
    copies = F.when(s > 0, F.col("copies") + more).otherwise(0).cast("bigint")
    told = rows.withColumn("n", copies)
    return told.select(
        "row.*",
        F.struct("size", "source_size", "target", F.col("n").alias("copies"), (F.col("n") * s).alias("taken")).alias(added),
    )


def _placed(rows: DataFrame) -> DataFrame:
    """The rows, written, with `_nth`: 0, 1, 2 ... within a source. Rows count up inside their partition,
    shifted by the source's rows in the partitions before: one line each, however large the source."""
    kept = cut(rows.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    inner = F.row_number().over(Window.partitionBy("source", "_part").orderBy("_id"))
    kept = kept.withColumn("_part", part)
    sizes = kept.groupBy("source", "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = cut(sizes.select(F.col("source").alias("_s"), F.col("_part").alias("_p"), F.coalesce(before, F.lit(0)).alias("_start")))
    counted = kept.withColumn("_k", inner).join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
    return counted.withColumn("_nth", F.col("_start") + F.col("_k") - 1).drop("_id", "_part", "_k", "_s", "_p", "_start")
