import pytest
from conftest import rows
from pyspark.sql import functions as F

from gondola.operators import basket, cube, dashboard, metrics, ranking, scale
from gondola.plans import tables

SF = "/root/testdata/sf0.001"
FOOD = ("Arroz blanco", "Manteca")


def test_name_grain(small_mart):
    prices = cube.by_name_month(small_mart)
    assert rows(metrics.average_by_name(prices)) == [
        ("Arroz blanco", 2025, 1, pytest.approx(331 / 3)), ("Arroz blanco", 2025, 3, 120.6),
        ("Manteca", 2025, 1, 50.0), ("Manteca", 2025, 2, pytest.approx(109.99 / 3)),
    ]
    spread = metrics.dispersion(prices, metrics.NAME_KEYS)
    assert spread.agg(F.min("indice_dispersion")).first()[0] == 0.0


def test_variation_uses_the_previous_row_present(small_mart):
    found = rows(metrics.variation_by_product(cube.by_product_month(small_mart)), "producto_id", "anio_mes", "variacion_mensual_pct")
    january = 331 / 3
    assert found == [
        (1, "2025-03", pytest.approx((120.6 - january) / january * 100)), (2, "2025-02", 0.0),
    ]
    days = rows(metrics.variation_daily(cube.by_product_day(small_mart)), "producto_id", "fecha")
    assert [p for p, _ in days] == [1, 1, 2, 2]


def test_extremes_break_ties_by_store_name(small_mart):
    found = rows(
        metrics.price_extremes(small_mart).filter("producto_id = 1 AND mes = 1"),
        "precio_minimo", "establecimiento_mas_barato", "precio_maximo", "establecimiento_mas_caro",
    )
    assert found == [(100.5, "Norte", 130.0, None)]


def test_baskets_and_rankings(small_mart):
    by_sum = basket.cost_by_observation(small_mart, FOOD)
    assert ("Sur", 2025, 1, 150.5) in rows(by_sum)
    by_mean = basket.cost_by_average(small_mart, FOOD)
    assert rows(by_mean.filter("mes = 2"), "establecimiento_id", "costo_total_canasta", "num_productos_canasta") == [
        (10, 9.99, 1), (11, 75.0, 1), (12, 25.0, 1),
    ]
    ranked = basket.rank_by_average(by_mean).filter("mes = 2")
    assert rows(ranked, "ranking", "establecimiento_id", "anio_mes") == [
        (1, 10, "2025-02"), (2, 12, "2025-02"), (3, 11, "2025-02"),
    ]
    assert len(basket.BASIC_BASKET) == len(set(basket.BASIC_BASKET)) == 64


def test_equal_costs_rank_by_store_name(spark):
    costs = spark.createDataFrame(
        [("b", 2025, 1, 5.0), ("a", 2025, 1, 5.0), ("c", 2025, 1, 1.0)],
        "supermercado string, anio int, mes int, costo_canasta double",
    )
    assert rows(basket.rank_by_observation(costs), "ranking", "supermercado") == [(1, "c"), (2, "a"), (3, "b")]


def all_metrics(mart):
    prices = cube.by_name_month(mart)
    return {
        "names": prices,
        "ids": cube.by_product_month(mart),
        "days": cube.by_product_day(mart),
        "extremes": metrics.price_extremes(mart),
        "category": metrics.by_category_chain_month(mart),
        "region": metrics.by_region_category_month(mart, 1998),
        "sum": basket.cost_by_observation(mart, ("blue bolt", "cold gear")),
        "avg": basket.cost_by_average(mart, ("blue bolt", "cold gear"), "nombre").drop("costo_total_canasta"),
    }


def test_large_dimensions_give_the_same_rows_without_broadcast(spark, monkeypatch):
    small = {k: rows(v) for k, v in all_metrics(tables.mart(spark, SF)).items()}
    monkeypatch.setattr(scale, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = all_metrics(tables.mart(spark, SF))
        plan = large["names"]._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
        assert {k: rows(v) for k, v in large.items()} == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_cube_gives_the_same_metrics_as_the_fact(spark):
    mart = tables.mart(spark, SF)
    states = cube.monthly_cube(mart)
    assert rows(cube.by_name_month(mart, states)) == rows(cube.by_name_month(mart))
    assert rows(cube.by_product_month(mart, states)) == rows(cube.by_product_month(mart))
    food = ("blue bolt", "cold gear")
    assert rows(basket.cost_by_observation(mart, food, states)) == rows(basket.cost_by_observation(mart, food))


def test_extremes_equal_a_self_join_on_the_extreme_price(spark):
    mart = tables.mart(spark, SF)
    named = mart.fact.join(mart.stores.frame, "establecimiento_id").selectExpr(
        "producto_id", "year(fecha) anio", "month(fecha) mes", "precio", "nombre"
    )
    keys = ["producto_id", "anio", "mes"]
    ends = named.groupBy(keys).agg(F.min("precio").alias("lo"), F.max("precio").alias("hi"))
    joined = named.join(ends, keys).groupBy(*keys, "lo", "hi").agg(
        F.min(F.when(F.col("precio") == F.col("lo"), F.col("nombre"))).alias("cheap"),
        F.min(F.when(F.col("precio") == F.col("hi"), F.col("nombre"))).alias("dear"),
    )
    ours = metrics.price_extremes(mart)
    assert rows(joined.select(*keys, "lo", "cheap", "hi", "dear")) == rows(
        ours, *keys, "precio_minimo", "establecimiento_mas_barato", "precio_maximo", "establecimiento_mas_caro"
    )


def test_integrated_without_a_join_equals_the_join(spark):
    prices = cube.by_name_month(tables.mart(spark, SF))
    joined = dashboard.integrate(
        metrics.dispersion(prices, metrics.NAME_KEYS), metrics.variation_by_name(prices)
    )
    single = dashboard.integrated(metrics.combined_by_name(prices))
    assert rows(joined.select(*single.columns)) == rows(single)


def test_rankings_are_one_to_n_per_month(spark):
    mart = tables.mart(spark, SF)
    ranked = basket.rank_by_observation(basket.cost_by_observation(mart, ("blue bolt", "cold gear")))
    bad = ranked.groupBy("anio", "mes").agg(
        F.min("ranking").alias("a"), F.max("ranking").alias("b"), F.count("*").alias("n"), F.count_distinct("ranking").alias("d")
    ).filter("a <> 1 OR b <> n OR d <> n")
    assert bad.count() == 0


def test_display_rounding_is_half_even(spark):
    shown = dashboard.display_rounded(spark.sql("SELECT 0.125D AS a, 0.375D AS b, 'x' AS c"))
    assert rows(shown) == [(0.12, 0.38, "x")]


def test_in_top_groups_breaks_frequency_ties_by_name(spark):
    table = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,), (None,)], "g string")
    assert rows(ranking.in_top_groups(table, "g", 2)) == [("a",), ("b",), ("b",)]
    assert rows(ranking.frequency(table, ["g"], 2)) == [("b", 2), (None, 2)]


def test_prices_off_the_scale_are_errors(spark):
    from gondola.functions import measures

    two = spark.createDataFrame([(1.005,), (1.005,)], "v double")
    big = spark.createDataFrame([(9e16,), (9e16,)], "v double")
    many = spark.range(3).selectExpr("CAST(4e18 AS BIGINT) AS v")
    before = spark.conf.get("spark.sql.ansi.enabled")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for rows_, column in ((two, measures.mean(F.col("v"), 2)), (big, measures.mean(F.col("v"), 2)), (many, measures.total(F.col("v")))):
                with pytest.raises(Exception, match="does not fit"):
                    rows_.agg(column).collect()
            assert two.agg(measures.mean(F.col("v"), 3)).first()[0] == 1.005
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)
