"""Every registered query against DuckDB: names, types, rows and values."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    # 0.0 and -0.0 are one value.
    plain = [
        tuple(0.0 if isinstance(r[i], float) and r[i] == 0 else r[i] for i in order) for r in rows
    ]
    return sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    types = {d[0]: str(d[1]) for d in found.description}
    expected = found.fetchall()
    assert sorted(names) == sorted(df.columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    mine, theirs = _sorted_rows(df.columns, rows), _sorted_rows(names, expected)
    assert len(mine) == len(theirs)
    differing = [(a, b) for a, b in zip(mine, theirs) if a != b]
    assert not differing, f"{len(differing)} rows differ, first {differing[0]}"


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
