"""Every registered query against its DuckDB oracle at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from fraudlake.plans.catalog import QUERIES  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(ocols, res.fetchall())[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt", "tr_id"]
    assert df.count() >= 0


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())
