"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from gondola.operators import profile
from gondola.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def ordered(found):
    cleaned = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in found]
    return sorted(cleaned, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, database, name):
    frame = contract.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    relation = database.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema} == kinds
    expected = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert ordered(frame.select(*[f"`{c}`" for c in columns]).collect()) == ordered(expected)


def test_sample_is_near_its_fraction_and_independent_of_partitions(spark):
    lines = spark.range(20_000).selectExpr("id AS a", "id % 7 AS b")
    first = sorted(r.a for r in profile.keyed_sample(lines, ["a", "b"], 0.1).collect())
    assert first == sorted(r.a for r in profile.keyed_sample(lines.repartition(7), ["a", "b"], 0.1).collect())
    assert 1_800 < len(first) < 2_200


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
