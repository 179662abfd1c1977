"""The registered queries of this package, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gondola.llm import (
    alignment, byte_bpe, chat, decontaminate, language_model, licences, mixing, near_dedup, quality_model, rules, token_counts, toxicity, whitening,
)
from gondola.llm.common import fold, table

#: Setting that names the driver's folder of vocabulary files; without it that of the installed package of public ones.
VOCABULARIES = "spark.gondola.vocabularies"


def vocabulary(spark: SparkSession, file: str) -> str:
    """The driver's path of a public tokenizer's file; workers get what they need of it by broadcast."""
    folder = spark.conf.get(VOCABULARIES, None)
    if folder is None:
        try:
            import public_tokenizers
        except ModuleNotFoundError as missing:
            raise FileNotFoundError(f"set {VOCABULARIES} to the folder that holds {file}") from missing
        return public_tokenizers.path(file)
    return f"{folder}/{file}"


def held(folds: int, one: int) -> Column:
    return F.coalesce(fold("doc_id", folds) == one, F.lit(False))


def op1_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Within a source, a document's inclusion odds grow with the root of its words."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, odds=F.sqrt(mixing.word_count()))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op2_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "licence.n_lines", F.col("licence.name").alias("license"), "licence.dice", "licence.line")


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.digests(chat.render(turns.unionByName(more)))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"), (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


def op5_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model.train(docs, table(spark, folder, "labels"))
    scored = quality_model.score(docs.withColumn("held_out", held(4, 2)), model)
    return scored.select("doc_id", "held_out", "quality.score", (F.col("quality.score") >= quality_model.KEEP).cast("int").alias("predicted"))


def op6_toxicity_ftrl(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs.withColumn("held_out", held(5, 0)), model)
    return scored.select("doc_id", "held_out", "toxicity.score", (F.col("toxicity.score") >= toxicity.TOXIC).cast("int").alias("predicted"))


def op7_setsketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.groups(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept"
    )


def op8_weak_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = rules.assess(docs, carry=["doc_id"])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = ~failed & (F.col("posterior") >= rules.KEEP)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *base, failed.alias("base_failed"), kept.alias("kept"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count(docs, token_counts.load_pieces(vocabulary(spark, "piece_bpe_32k.model")))
    return counted.select("doc_id", "tokens.n_words", "tokens.n_tokens", F.col("tokens.most").alias("most_tokens"))


def op10_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text").withColumn("held_out", held(7, 2))
    model = language_model.train(docs.where("not held_out"))
    scored = language_model.score(docs, model)
    return scored.select(
        "doc_id", "held_out", "lm.n_tokens", "lm.n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "lm.base_score", "lm.score"
    )


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """A deviation beyond 64 bits is null here; the operator has it as a decimal."""
    white = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return white.select(
        "row.vec_id", "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened", "explained", "identity_error",
    )


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    own = alignment.load(vocabulary(spark, "byte_bpe_50k.json"), vocabulary(spark, "piece_bpe_32k.model"))
    return alignment.align(docs, own, alignment.count(docs, own)).select("doc_id", "links.*")


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ranks = byte_bpe.load_ranks(vocabulary(spark, "byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.digests(docs, ranks, byte_bpe.PATTERN).select("doc_id", "bpe.*")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pareto_mix, op2_licence_scan, op3_chat_format, op4_decontaminate, op5_quality_trees, op6_toxicity_ftrl,
        op7_setsketch_dedup, op8_weak_rules, op9_token_counts, op10_kneser_ney, op11_whitening, op12_alignment,
        op13_byte_bpe,
    )
}
