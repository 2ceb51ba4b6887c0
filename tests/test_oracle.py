"""Every query against its SQL on another engine, over whole tables."""

import duckdb
import pytest
from pyspark.sql import types as T

from feira import oracle, queries

FOLDER = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    T.StringType(): "VARCHAR",
    T.IntegerType(): "INTEGER",
    T.LongType(): "BIGINT",
    T.DoubleType(): "DOUBLE",
    T.BooleanType(): "BOOLEAN",
    T.TimestampNTZType(): "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = queries.queries()[name](spark, FOLDER)
    result = duck.execute(oracle.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    kinds = {column[0]: str(column[1]) for column in result.description}
    assert {f.name: TYPES[f.dataType] for f in df.schema} == kinds
    expected = sorted(map(repr, result.fetchall()))
    assert expected, "a check on no rows checks nothing"
    assert sorted(repr(tuple(row)) for row in df.select(*columns).collect()) == expected


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())
