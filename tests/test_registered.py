"""Every registered query against its SQL, on the smallest given tables."""

import duckdb
import pytest
from conftest import TINY

import __spark_entry__ as driver
from tidemart.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TINY}/{name}.parquet'")
    return con


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple("~" if r[i] is None else str(r[i]) for i in order) for r in data]
    return sorted(shown)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    result = driver.queries()[name](spark, TINY)
    got = [tuple(r) for r in result.collect()]
    assert set(dict(result.dtypes).values()) <= {*TYPES, "array<string>"}
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    answer = oracle.execute(sql)
    columns = [c[0] for c in answer.description]
    kinds = {c[0]: str(c[1]) for c in answer.description}
    assert sorted(result.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in result.dtypes} == kinds
    assert _rows(result.columns, got) == _rows(columns, answer.fetchall())


def test_entry(spark):
    rows = driver.entry(spark)
    assert rows.count() == 30
    assert rows.columns[0] == "date"
