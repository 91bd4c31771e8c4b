"""Every query against its SQL counterpart in DuckDB, over the given tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from emberlog.registry.oracles import ORACLES
from emberlog.registry.queries import QUERIES

TABLES = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in NAMES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return connection


# DuckDB's name of each Spark type; integer widths must agree as well.
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        return "NaN" if isinstance(value, float) and math.isnan(value) else value

    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, TABLES)
    expected = duck.sql(contract.oracle_sql()[name])
    spark_types = {f.name: KINDS[f.dataType.simpleString()] for f in result.schema.fields}
    duck_types = {c: str(t) for c, t in zip(expected.columns, expected.types)}
    assert spark_types == duck_types
    got = _bag(result.columns, result.collect())
    want = _bag(expected.columns, expected.fetchall())
    assert sum(got.values()) > 0
    assert got == want


def test_every_query_is_compared():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry_has_the_declared_schema(spark):
    from emberlog.schemas import GOLD

    result = contract.entry(spark)
    assert [(f.name, f.dataType) for f in result.schema.fields] == [
        (f.name, f.dataType) for f in GOLD.fields
    ]
    assert result.count() == 572
