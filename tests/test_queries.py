"""Every registered query against DuckDB on the smallest data folder."""
import math
from pathlib import Path

import duckdb
import pytest

from lociframe.plans import CHECKS, QUERIES
from lociframe.plans.views import TABLES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test data not there")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def plain(value):
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    assert name in CHECKS
    found = database.execute(CHECKS[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=key)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=2e-6)), (a, b)
