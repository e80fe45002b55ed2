"""Queries of the subpackage equal their DuckDB SQL on the small fixture."""

import duckdb
import pytest

from formmart.llm import registry as R


@pytest.mark.parametrize("name", sorted(R.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    res = con.execute(R.ORACLES[name])
    columns = [d[0] for d in res.description]
    want = sorted(map(repr, res.fetchall()))
    df = R.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in R.QUERIES} == set(range(1, 11))
