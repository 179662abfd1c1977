"""The pipeline's stages, each on what its predecessor kept."""

import corpus_pipeline
import pytest
from llm.conftest import prose
from llm.test_registered import brute_groups, shingles
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, frames[-1], SF)
        frames.append(spark.createDataFrame(found.collect(), found.schema))
    return frames


def test_stages_filter_whole_rows(kept):
    for before, after in zip(kept, kept[1:-1]):
        assert after.columns == kept[0].columns
        assert 0 < after.count() <= before.count()
        assert set(after.collect()) <= set(before.collect())


def test_one_of_each_group_stays(kept):
    before = {r.doc_id: shingles(r.text) for r in kept[2].collect()}
    assert {r.doc_id for r in kept[3].collect()} == set(brute_groups(before, 80).values())


def test_no_benchmark_window_is_left(spark, kept):
    from gondola.llm import decontaminate

    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.scan(kept[4], benchmark).where("hits.n_hit > 0").count() == 0
    gone = {r.doc_id for r in kept[3].collect()} - {r.doc_id for r in kept[4].collect()}
    assert gone == {r.doc_id for r in decontaminate.scan(kept[3], benchmark).where("hits.n_hit > 0").collect()}


def test_the_mix_repeats_documents(kept):
    rows = kept[5].collect()
    assert {r.mix.copy for r in rows} <= {0, 1}
    targets = {r.source: r.mix.target for r in rows}
    words = {s: sum(r.mix.size for r in rows if r.source == s) for s in targets}
    largest = max(r.mix.size for r in rows)
    assert all(abs(words[s] - t) <= largest / 2 for s, t in targets.items())


def test_run_equals_its_stages(spark, kept):
    found = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.mix.copy) for r in found.collect()) == sorted((r.doc_id, r.mix.copy) for r in kept[5].collect())


CLASHING = "size bigint, target double, copy int, row string, n bigint, score double, text2 string, _quality string, hits string, posterior double, k string, mix string"


def test_stages_of_odd_rows_and_clashing_names(spark):
    """Nulls, blanks, repeats, long texts and columns named like the operators' own."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = [part.split() for part in CLASHING.split(", ")]
    wide = docs.withColumns({c: F.lit("1").cast(kind) for c, kind in named})
    odd = spark.createDataFrame(
        [(None, None, None), (None, "", "a"), (-1, " \n\t", None), (-2, prose(1, 3000, 2000), "a"), (-2, prose(1, 3000, 2000), "a"), (-2, prose(2, 300, 900), None), (None, prose(3, 300, 900), "a")],
        "doc_id bigint, text string, source string",
    )
    wide = wide.unionByName(odd, allowMissingColumns=True)
    for (name, stage), last in zip(corpus_pipeline.STAGES, [False] * 4 + [True]):
        found = stage(spark, wide, SF)
        names = [c for c in wide.columns if c != "mix"]
        assert found.columns == ([*names, "mix"] if last else wide.columns), name
        whole = {(r.doc_id, r.text) for r in wide.select("doc_id", "text").collect()}
        assert {(r.doc_id, r.text) for r in found.select("doc_id", "text").collect()} <= whole, name
        assert found.where("doc_id >= 0").count() > 0, name
        if name in ("quality rules", "mix"):
            assert found.where("text is null or trim(text) = ''").count() == 0, name


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
