"""Operators that take another way for large groups must agree with the plain way."""

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from gondola.operators import profile, quantiles, ranking, scale


@pytest.fixture
def skewed(spark):
    """One group holds most rows, and most of its rows share a value."""
    return spark.range(6000).selectExpr(
        "IF(id % 10 < 8, 'hot', IF(id % 10 = 8, 'b', NULL)) AS g",
        "CASE WHEN id % 3 = 0 THEN 7.5D ELSE pmod(hash(id), 1000) / 4D END AS v",
        "id AS k",
    )


def test_split_numbering_equals_the_window(skewed):
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v", "k")))
    split = ranking.number_rows(skewed, ["g"], ["v", "k"], "n")
    assert rows(split) == rows(plain)
    assert dict(split.dtypes)["n"] == "bigint"
    assert split.columns == plain.columns


@pytest.mark.parametrize("count, accuracy", [(quantiles.STEPS, quantiles.ACCURACY), (20, 200)])
def test_quantiles_of_groups(skewed, count, accuracy):
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = quantiles.exact_quantiles(skewed, "v", wanted, ["g"], count, accuracy).collect()
    data = skewed.filter("g IS NOT NULL").toPandas()
    assert {r.g for r in found} == {"hot", "b"}
    for r in found:
        values = data.v[data.g == r.g]
        assert r.n == len(values) and r.minimo == values.min() and r.maximo == values.max()
        assert r.media == pytest.approx(values.mean()) and r.desviacion == pytest.approx(values.std())
        np.testing.assert_allclose(r.cuantiles, np.quantile(values, wanted), rtol=1e-12)


def test_quantiles_of_many_distinct_values(spark):
    table = spark.range(200_000).selectExpr("pow((hash(id) % 1000003) / 1e6D, 9) AS v")
    found = quantiles.exact_quantiles(table, "v", [0.001, 0.25, 0.5, 0.999], [], 50, 500).first()
    np.testing.assert_allclose(found.cuantiles, np.quantile(table.toPandas().v, [0.001, 0.25, 0.5, 0.999]), rtol=1e-12)


def test_quantiles_join_without_nested_loops(spark):
    table = spark.range(50).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS v")
    for by in ([], ["g"]):
        for frame in (quantiles.exact_quantiles(table, "v", [0.5], by), profile.box(table, "v", by)):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_rows_no_quantiles(spark):
    table = spark.range(0).selectExpr("id AS g", "CAST(id AS DOUBLE) AS v")
    assert quantiles.exact_quantiles(table, "v", [0.5], ["g"]).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6) | st.sampled_from([1.0, 2.0]), min_size=1, max_size=60))
def test_quantiles_of_any_list(spark, values):
    table = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    found = quantiles.exact_quantiles(table, "v", [0.25, 0.5], []).first()
    np.testing.assert_allclose(found.cuantiles, np.quantile(values, [0.25, 0.5]), rtol=1e-9, atol=1e-9)
    assert found.n == len(values)


def test_histogram_edges(spark):
    table = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (None,), (float("nan"),)], "v double")
    assert rows(profile.histogram(table, "v", 10), "bin", "cantidad") == sorted({**dict.fromkeys(range(10), 0), 0: 1, 1: 1, 9: 2}.items())
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert rows(profile.histogram(same, "v", 10)) == [(0, 3.0, 2)]
    assert profile.histogram(table.limit(0), "v", 10).count() == 0


def test_box_counts_outliers(spark):
    table = spark.createDataFrame([(float(v),) for v in [*range(1, 12), 100]], "v double")
    box = profile.box(table, "v", []).first()
    assert (box.cantidad, box.bigote_inferior, box.bigote_superior, box.atipicos) == (12, 1.0, 11.0, 1)


def test_approx_quartiles_are_close(skewed):
    exact = np.quantile(skewed.toPandas().v, [0.25, 0.5, 0.75])
    np.testing.assert_allclose(profile.approx_quartiles(skewed, "v").first(), exact, atol=0.5)


def test_dimension_size_is_measured(spark):
    table = spark.createDataFrame([("abc", 1), (None, 2)], "s string, i int")
    assert scale.measure(table) == (2, 2 * 32 + 3)
    assert scale.measure(table.limit(0)) == (0, 0)


def test_overwritten_dimension_is_measured_again(spark, tmp_path):
    from gondola.operators.facts import Dimension

    path = str(tmp_path / "dim")
    for rows_now in (3, 5_000):
        spark.range(rows_now).write.mode("overwrite").parquet(path)
        assert Dimension(lambda: spark.read.parquet(path), "id").rows == rows_now


def test_hot_keys_are_split(spark):
    """A third of the rows has one key, another key a tenth; no broadcast, no splitting by the engine."""
    from gondola.operators import skew

    for name, value in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}.items():
        spark.conf.set(name, value)
    try:
        rows_ = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN 8 WHEN id % 97 = 2 THEN NULL ELSE id % 5000 END AS k", "id AS v").repartition(8)
        side = spark.range(4_000).selectExpr("id AS k", "id * 2 AS w").unionAll(spark.sql("SELECT 7L, -1L"))
        assert set(skew.hot_keys(rows_, "k")) == {7, 8}
        found = skew.join(rows_, side, "k")
        plain = rows_.join(side, "k")
        assert rows(found.select("k", "v", "w")) == rows(plain.select("k", "v", "w"))
        semi = skew.join(rows_, side, "k", "left_semi")
        assert rows(semi.select("k", "v")) == rows(rows_.join(side, "k", "left_semi").select("k", "v"))
        sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] < 2 * sizes[len(sizes) // 2]
        worst = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
        assert worst[-1] > 4 * worst[len(worst) // 2]
        assert rows(skew.join(side, side.withColumnRenamed("w", "x"), "k").select("k", "x")) == rows(side.join(side.withColumnRenamed("w", "x"), "k").select("k", "x"))
        assert skew.hot_keys(rows_.limit(0), "k") == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_large_dimensions_give_the_same_fact(spark, small_mart, monkeypatch):
    from gondola.operators import facts

    text = small_mart.fact.selectExpr("fecha", "CAST(producto_id AS STRING) producto_id", "CAST(establecimiento_id AS STRING) establecimiento_id", "precio", "oferta")
    small = rows(facts.fact_prices(text, small_mart.products, small_mart.stores, small_mart.locations))
    monkeypatch.setattr(scale, "BROADCAST_BYTES", 0)
    assert rows(facts.fact_prices(text, small_mart.products, small_mart.stores, small_mart.locations)) == small != []


def test_carried_states_equal_the_whole_window(spark):
    from gondola.operators import metrics

    of = ("s", ["y", "m"], "v")
    data = [(s, 2020 + k // 12, k % 12 + 1, float(k * 7 % 11)) for s in ("a", "b", None) for k in range(30) if (k * (3 if s else 5)) % 7]
    history = spark.createDataFrame([*data, ("new", 2022, 6, 1.0), ("old", 2020, 1, 2.0)], "s string, y int, m int, v double")
    whole = metrics.with_previous(history, *of, "p").filter("y = 2022")
    past = metrics.advance(metrics.carried(history.filter("y = 2020"), *of), history.filter("y = 2021"), *of)
    assert rows(past) == rows(metrics.carried(history.filter("y < 2022"), *of))
    found = metrics.with_carried(history.filter("y = 2022"), past, *of, "p")
    assert found.columns == whole.columns and rows(found) == rows(whole)
    assert rows(metrics.with_carried(history, past.limit(0), *of, "p")) == rows(metrics.with_previous(history, *of, "p"))


def test_distinct_states_merge(spark):
    table = spark.range(30_000).selectExpr("id % 3 AS a", "id % 7 AS b", "id % 5000 AS v")
    found = profile.distinct_rollup(profile.distinct_states(table, ["a", "b"], "v"), ["a"]).collect()
    assert len(found) == 3 and all(abs(r.distintos - 5000) <= 200 for r in found)


@pytest.mark.parametrize("slack, size", [(quantiles.SLACK, quantiles.KLL), (1e-6, 8)])
def test_quantiles_from_stored_sketches_are_exact(skewed, monkeypatch, slack, size):
    """Also where small sketches bracket the wrong values."""
    monkeypatch.setattr(quantiles, "SLACK", slack)
    monkeypatch.setattr(quantiles, "KLL", size)
    wanted = [0.1, 0.5, 0.93]
    table = skewed.filter("g IS NOT NULL").withColumn("m", F.col("k") % 5)
    stored = scale.cut(quantiles.states(table, "v", ["g", "m"]))
    data = table.toPandas()
    for by in (["g"], []):
        found = quantiles.quantiles_from_states(table, "v", wanted, stored, by).collect()
        assert len(found) == (2 if by else 1)
        for r in found:
            values = data.v[data.g == r.g] if by else data.v
            assert (r.n, r.minimo, r.maximo) == (len(values), values.min(), values.max())
            np.testing.assert_allclose(r.cuantiles, np.quantile(values, wanted), rtol=1e-12)
    assert quantiles.quantiles_from_states(table.limit(0), "v", wanted, stored.limit(0), ["g"]).count() == 0
