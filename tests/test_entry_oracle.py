import duckdb
import pytest

import __spark_entry__ as E
from stellate.plans.registry import QUERIES
from stellate.sources import TABLES

from conftest import SF_SMOKE


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "fire_id" in df.columns and "year" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMOKE)
    rel = con.sql(E.oracle_sql()[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: _DUCK.get(t, t.upper()) for c, t in df.dtypes} == duck_types
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    idx = [ocols.index(c) for c in order]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
