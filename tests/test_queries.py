"""Every registered query against its SQL in DuckDB, on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans.queries import QUERIES
from tests.conftest import DATA

FOLDER = DATA / os.environ.get("TIDEMARK_SF", "sf0.01")
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float) and math.isnan(value):
            return "NaN"
        return value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, str(FOLDER))
    result = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert dict(df.dtypes) == {d[0]: TYPES[str(d[1])] for d in result.description}
    expected = normal(result.fetchall(), columns)
    actual = normal([tuple(row) for row in df.collect()], df.columns)
    assert len(actual) == len(expected)
    assert actual == expected
    assert expected


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 1
