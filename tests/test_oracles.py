"""Every registered query runs; those with SQL must match DuckDB on the same files."""

import os

import pytest

import webloom.plans as plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"topic_terms", "train_classifier"}  # model fits, covered by test_models.py

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return str(value)


def table(columns, rows):
    names = sorted(columns)
    at = [list(columns).index(c) for c in names]
    return names, sorted(tuple(str(canonical(r[i])) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - SLOW))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    sql = plans.ORACLES.get(name)
    if sql is None:
        assert got[0]
        return
    result = duck.execute(sql)
    want = table([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_oracle_has_a_query():
    assert set(plans.ORACLES) <= set(plans.QUERIES)
