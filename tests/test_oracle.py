"""Every registered query against its DuckDB oracle on the smallest test data."""
import datetime as dt
import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.fixtures import TABLES

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from strata.plans.registry import ORACLES, QUERIES
    assert set(ORACLES) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(rel.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "customer_email_id", "customer_name_id",
                          "customer_address_id", "customer_phone_id", "parent_customer_id"]
    assert df.count() > 0
