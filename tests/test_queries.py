"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, canonical_rows
from workload.all import ORACLE, QUERIES

TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns, got = canonical_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(ORACLE[name])
    described = result.description
    want_columns, want = canonical_rows([d[0] for d in described], result.fetchall())
    assert columns == want_columns
    assert dict(df.dtypes) == {d[0]: TYPES[str(d[1])] for d in described}
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5
