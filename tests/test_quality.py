from conftest import rows

from gondola.operators import quality
from gondola.operators.quality import ForeignKey, InDomain, InRange, NotNull, Unique


def tables(spark):
    child = spark.sql(
        """SELECT * FROM VALUES (1, 10.0D, 'a'), (1, 10.0D, 'a'), (2, NULL, 'b'), (NULL, -1.0D, NULL), (9, 0.0D, 'z')
        AS t(k, v, d)"""
    )
    return {"child": child, "parent": spark.sql("SELECT * FROM VALUES (1), (2), (2) AS t(k)")}


def outcome(spark, *checks):
    found = quality.evaluate(tables(spark), checks)
    return {(r.tabla, r.check_type, r.columna): (r.total_rows, r.failed_rows, r.passed) for r in found.collect()}


def test_planted_defects_are_counted(spark):
    assert outcome(
        spark,
        NotNull("child", ("k", "v", "absent")),
        InRange("child", "v", low=0),
        InRange("child", "v", high=5),
        InDomain("child", "d", ("a", "b")),
        ForeignKey("child", "k", "parent", "k"),
        Unique("child"),
        Unique("parent", ("k",)),
    ) == {
        ("child", "null_values", "k"): (5, 1, False),
        ("child", "null_values", "v"): (5, 1, False),
        ("child", "range_validation", "v"): (5, 3, False),
        ("child", "consistency", "d"): (5, 2, False),
        ("child -> parent", "referential_integrity", "k"): (5, 2, False),
        ("child", "duplicates", ""): (5, 1, False),
        ("parent", "duplicates", "k"): (3, 1, False),
    }


def test_range_without_bounds_passes_and_with_one_bound_fails_nulls(spark):
    assert outcome(spark, InRange("child", "v"))[("child", "range_validation", "v")] == (5, 0, True)
    assert outcome(spark, InRange("child", "v", low=-10))[("child", "range_validation", "v")] == (5, 1, False)


def test_absent_columns_are_skipped_and_the_check_passes(spark):
    assert outcome(spark, NotNull("child", ("absent",))) == {("child", "null_values", ""): (5, 0, True)}


def test_empty_table_passes_with_zero_percent(spark):
    empty = {"child": tables(spark)["child"].limit(0), "parent": tables(spark)["parent"]}
    found = quality.evaluate(
        empty, [NotNull("child", ("k",)), InRange("child", "v", 0), Unique("child", ("k",)), ForeignKey("child", "k", "parent", "k")]
    )
    assert {(r.failed_rows, r.failed_pct, r.passed) for r in found.collect()} == {(0, 0.0, True)}


def test_report_has_one_row_per_check_and_the_summary_adds_them_up(spark):
    found = quality.evaluate(
        tables(spark), [NotNull("child", ("k", "v")), NotNull("parent", ("k",)), InDomain("child", "d", ("a",))]
    )
    report = quality.report(found)
    assert rows(report, "table", "check_type", "passed") == [
        ("child", "consistency", False), ("child", "null_values", False), ("parent", "null_values", True),
    ]
    assert "child null_values: 2 of 5" in {r.message for r in report.collect()}
    total = quality.summary(report).first()
    assert (total.total_checks, total.passed, total.failed, total.all_passed) == (3, 1, 2, False)
    assert quality.summary(report.limit(0)).first().all_passed
    assert len(quality.STAR_CHECKS) == 20


def test_profiles(spark):
    child, parent = tables(spark).values()
    assert rows(quality.null_profile(child, "child"), "columna", "nulos", "porcentaje") == [
        ("d", 1, 20.0), ("k", 1, 20.0), ("v", 1, 20.0),
    ]
    assert rows(quality.duplicate_profile(child, "child"), "total_rows", "unicos", "duplicados") == [(5, 4, 1)]
    assert rows(quality.orphan_keys(child, parent, "k")) == [(9,), (None,)]
