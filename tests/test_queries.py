"""Every query against its SQL, in DuckDB, on the same tables."""

import math

import duckdb
import pytest

from formloom.plans import oracle, queries

TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()


@pytest.fixture(scope="module", params=["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def tables(request):
    """A folder of tables, and DuckDB over them."""
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{request.param}/{t}.parquet'")
    return request.param, c


def normal(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v) if v.__class__.__name__ in ("datetime", "Decimal") else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return sorted((tuple(normal(r[i]) for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, tables, name):
    sf, con = tables
    df = queries.QUERIES[name](spark, sf)
    got = df.collect()
    if name not in oracle.SQL:
        assert got
        return
    want = con.sql(oracle.SQL[name])
    assert sorted(map(str.lower, df.columns)) == sorted(map(str.lower, want.columns))
    a, b = rows(df.columns, got), rows(want.columns, want.fetchall())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == y


def test_all_sql_has_a_query():
    assert set(oracle.SQL) <= set(queries.QUERIES)
