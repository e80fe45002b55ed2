"""Every registered query with an oracle equals its DuckDB SQL on the small fixture."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from formmart.plans.registry import ORACLES

TABLES = "region nation customer supplier part orders lineitem".split()


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = E.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    spark2duck = {"long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "date": "DATE", "boolean": "BOOLEAN"}
    dtypes = {d[0]: str(d[1]).upper() for d in res.description}
    for f in df.schema.fields:
        assert spark2duck.get(f.dataType.typeName()) == dtypes[f.name], (f.name, f.dataType, dtypes[f.name])
    assert len(rows) == len(drows)
    assert _bag(rows, df.columns) == _bag(drows, dcols)


def test_every_query_has_rows_or_is_known(spark, sf_dir):
    q = E.queries()
    assert set(E.oracle_sql()) <= set(q)
    for name in ("std_games_no_id", "catalog_listing"):
        assert q[name](spark, sf_dir).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "star_pts_avg_l5_sum" in df.columns
