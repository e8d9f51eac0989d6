"""Every check query against its SQL twin, on the smallest test tables."""

import math
import os

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    connections = {}
    for folder in (FOLDER, LARGER):
        connections[folder] = duckdb.connect()
        for name in TABLES:
            connections[folder].execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connections


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


# queries of the optional parts are tested with those parts
OWN = sorted(contract.QUERIES)
# no nation has three suppliers in the smallest tables; these are compared at the next size
LARGER = "/root/testdata/sf0.01"
SPARSE = {"cmp_generic", "cmp_org", "cmp_org_chunks"}


def test_every_query_has_a_twin():
    assert set(contract.QUERIES) == set(contract.ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns[0] == "id" and rows.count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, sql, name):
    folder = LARGER if name in SPARSE else FOLDER
    df = contract.queries()[name](spark, folder)
    cursor = sql[folder].execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = rows_of(columns, cursor.fetchall())
    assert expected and rows_of(df.columns, df.collect()) == expected
