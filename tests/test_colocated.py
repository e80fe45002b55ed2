"""Joins by game over bucketed tables."""

import datetime as dt

import pytest

from formmart import schemas as S
from formmart.operators import features as V
from formmart.plans.fixture_mart import mart_for


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_opponent_and_star_joins_have_no_exchange(spark, sf_dir):
    m = mart_for(spark, sf_dir)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables that are too large for it
    try:
        opponent = physical(V.opponent_join(m.team_form()))
        enriched = physical(V.enrich(m.training_dataset(), m.team_star_features()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    for plan in (opponent, enriched):
        assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert enriched.count("SortMergeJoin") == 1


def test_enrich_equals_two_left_joins(spark):
    """Missing sides, unknown games, three teams in a game, and two rows of one team."""
    base = spark.createDataFrame([("g1", 1, 2), ("g1", 2, 1), ("g2", 1, 3), ("g3", 5, 6), ("g4", 7, 7), (None, 1, 2)],
                                 "game_id string, team_id long, opponent_team_id long")
    day = dt.date(2020, 1, 1)
    stars = spark.createDataFrame([("g1", 1, 1.0), ("g1", 2, 2.0), ("g1", 9, 9.0), ("g2", 1, 3.0), ("g2", 3, 4.0), ("g2", 3, 5.0),
                                   ("g4", 7, 6.0), ("g4", 7, 7.0), ("g4", None, 8.0), (None, 1, 1.0)],
                                  "game_id string, team_id long, v double").selectExpr(
        "game_id", "team_id", f"DATE'{day}' AS game_date", *[f"v + {i} AS {c}" for i, c in enumerate(S.STAR_FEATURES)])
    base.createOrReplaceTempView("b")
    stars.createOrReplaceTempView("s")
    want = spark.sql("SELECT b.*, " + ", ".join(f"o.{c}" for c in S.STAR_FEATURES) + ", " + ", ".join(
        f"p.{c} AS opp_{c}" for c in S.STAR_FEATURES) + " FROM b LEFT JOIN s o ON o.game_id = b.game_id AND o.team_id = b.team_id "
        "LEFT JOIN s p ON p.game_id = b.game_id AND p.team_id = b.opponent_team_id")
    got = V.enrich(base, stars)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_closing_a_mart_drops_its_tables(spark, sf_dir):
    from formmart.plans.mart import Mart
    m = Mart(spark, mart_for(spark, sf_dir).tables)
    before = {t.name for t in spark.catalog.listTables()}
    m.training_dataset()
    made = {t.name for t in spark.catalog.listTables()} - before
    assert made and all(n.startswith("fm_") for n in made)
    m.close()
    assert not made & {t.name for t in spark.catalog.listTables()}
