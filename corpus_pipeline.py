"""A training corpus from raw documents: five stages of the operators in gondola/llm.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
`documents`; the last one returns each document as often as the mix takes it, with a struct `mix` of its
size in words, its source's target and its copy's number.

Defined results, for all stages: null, empty and blank texts have no words; the rules stage drops them, as
any text of under ten words. Repeated rows are judged alike until the third stage leaves one of them. Null ids
stay, and rows are told apart by id and set of shingles. Null is a source of its own. Of equal scores all
rows stay. An empty table gives no rows, and columns beyond those of `documents` pass through whatever
their names (but a column `mix` is replaced by the last stage). Without usable labels every quality score is
0.5, below the limit, and no document stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.llm import decontaminate, mixing, near_dedup, quality_model, rules
from gondola.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the trees score below the limit go."""
    return quality_model.keep(docs, quality_model.train(docs, table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents whose posterior of being good is below one half, or that fail its base rules, go."""
    return rules.keep(docs, failed=rules.base_failed())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of documents linked at 0.8 one row stays, with the smallest id."""
    return near_dedup.keep(docs, percent=80, bands=40, rows=5, repeats=False)


def benchmark_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: sources mixed to their targets; a document taken twice is two rows."""
    docs = docs.drop("mix")
    mixed = mixing.mix(docs, added="mix").select(F.struct(*docs.columns).alias("row"), "mix")
    copies = F.sequence(F.lit(0), F.col("mix.copies").cast("int") - 1)
    taken = mixed.where("mix.copies > 0").select("row", "mix", F.explode(copies).alias("copy"))
    return taken.select("row.*", F.struct("mix.size", "mix.target", "copy").alias("mix"))


STAGES = [
    ("quality classifier", quality),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_windows),
    ("mix", mix),
]

#: Trees, expectation-maximisation and components are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. Each stage's result is a Parquet table in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
