"""Every registered query against its DuckDB statement on the smallest tables.

Same comparison as the driver: row count, column names and an
order-insensitive hash of the values.
"""

import os

import pytest

import __spark_entry__ as entry
from impactspark.plans.catalog import load_all
from impactspark.session import configure
from tools.oracle_check import TABLES, digest

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = load_all()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](configure(spark), SF)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    rel = duck.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    want = rel.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(got) == len(want)
    assert digest(cols, got)[0] == digest(dcols, want)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "age_range" in df.columns
