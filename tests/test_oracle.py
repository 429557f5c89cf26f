"""Every registered query against its oracle SQL on the smallest tables."""

from functools import lru_cache
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from plumbline.workloads import queries as Q
from plumbline.workloads.views import BASE

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in BASE:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')"
        )
    return connection


@pytest.fixture(scope="module", autouse=True)
def shared_findings():
    """Six queries look at the same findings; compute them once here."""
    original = Q._findings
    Q._findings = lru_cache(original)
    yield
    Q._findings = original


def text(value):
    return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)


def rows_by_name(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query(spark, oracle, name):
    found = entry.queries()[name](spark, FOLDER)
    rows = found.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = oracle.execute(sql)
    columns = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    assert sorted(found.columns) == sorted(columns)
    for field in found.schema.fields:
        if columns[field.name] != '"NULL"':
            assert TYPES[field.dataType.simpleString()] == columns[field.name], field.name
    assert rows_by_name(rows, found.columns) == rows_by_name(expected, list(columns))
