"""Every registered query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as spark_entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return None if math.isnan(value) else round(value, 6)
        return value

    return sorted([tuple(cell(row[i]) for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(spark_entry.queries()))
def test_query(spark, sql, sf_dir, name):
    df = spark_entry.queries()[name](spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    statement = spark_entry.oracle_sql().get(name)
    if statement is None:
        assert rows
        return
    result = sql.execute(statement)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, rows) == canonical(columns, result.fetchall())


def test_every_sql_twin_belongs_to_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_flagship_query_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0
