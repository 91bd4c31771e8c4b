"""Queries against their SQL counterparts, over the tables that the driver compares on."""

from collections import Counter

import duckdb
import pytest

from emberlog.llm.oracles import ORACLES
from emberlog.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.01"
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    expected = duck.sql(ORACLES[name])
    result = QUERIES[name](spark, TABLES)
    assert {f.name: KINDS[f.dataType.simpleString()] for f in result.schema} == dict(
        zip(expected.columns, map(str, expected.types))
    )
    columns = sorted(result.columns)
    want = Counter(tuple(row[expected.columns.index(c)] for c in columns) for row in expected.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in result.collect()) == want
    assert want
