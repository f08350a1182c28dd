"""Every registered query of the library proper against DuckDB on the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

from skein.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)[:19].removesuffix(" 00:00:00")
    return v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr([plain(x) for x in r]) for r in df.select(*cols).collect())
    r = duck.sql(registry.ORACLES[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    assert got == sorted(repr([plain(x[i]) for i in at]) for x in r.fetchall())
    assert got
