"""Every query against its independent SQL, on the supplied tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()
KINDS = {
    "VARCHAR": {"string"}, "BIGINT": {"bigint"}, "INTEGER": {"int"}, "DOUBLE": {"double"}, "DATE": {"date"},
    "BOOLEAN": {"boolean"}, "TIMESTAMP": {"timestamp", "timestamp_ntz"},
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def by_name(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    names, types = [d[0] for d in result.description], {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    assert sorted(frame.columns) == sorted(names)
    assert all(kind in KINDS[types[column]] for column, kind in frame.dtypes)
    assert by_name(frame.columns, frame.collect()) == by_name(names, expected)
    assert expected or name == "daily_empty_range"


def test_all_queries_of_events_have_sql():
    from workload.queries import all_queries

    assert not set(all_queries()) - set(SQL)


def test_entry(spark):
    assert contract.entry(spark).count() == 5
