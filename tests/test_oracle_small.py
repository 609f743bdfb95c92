"""Registered queries against their DuckDB SQL on the smallest scale."""
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from meterflow.plans.catalog import QUERIES
from testdata_paths import SF_SMALL

def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
        return "∅" if v is None else str(v)
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, df.columns) == _digest(drows, dcols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "doc_id" in df.columns


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", ["index_routing", "load_profile", "retention_keep", "detect_silence"])
def test_results_do_not_depend_on_session_zone(spark, con, name):
    key = "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")
    try:
        test_query_matches_sql(spark, con, name)
    finally:
        spark.conf.set(key, old)
