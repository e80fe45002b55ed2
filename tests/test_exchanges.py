"""The standard tables move the lineitems once each, and give the same rows when an order is hot."""

from formmart.plans.mart import Mart, StandardTables
from formmart.sources import fixtures as FX


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def _rows(df):
    return sorted(df.collect(), key=str)


def test_games_need_one_exchange_of_lineitems(spark, sf_dir):
    dealt = _exchanges(FX.fixture_games(spark, sf_dir))
    assert [x for x in dealt if "l_orderkey" in x and "o_orderkey" not in x] == dealt[:1]


def test_player_games_are_aggregated_where_they_are_joined(spark, sf_dir):
    games = FX.fixture_games(spark, sf_dir).localCheckpoint()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert all("hashpartitioning(l_partkey" not in x for x in _exchanges(FX.fixture_player_games(spark, sf_dir, games)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_orders_give_the_same_rows(spark, sf_dir, monkeypatch):
    games = FX.fixture_games(spark, sf_dir)
    want, want_players = _rows(games), _rows(FX.fixture_player_games(spark, sf_dir, games))
    hot_keys = FX.hot_keys
    monkeypatch.setattr(FX, "hot_keys", lambda df, keys: hot_keys(df, keys, max_rows=3))
    assert hot_keys(FX.driver_table(spark, sf_dir, "lineitem"), "l_orderkey", max_rows=3) is not None
    assert _rows(FX.fixture_games(spark, sf_dir)) == want
    assert _rows(FX.fixture_player_games(spark, sf_dir, games)) == want_players


def test_opponents_meet_without_exchange_in_a_plain_session(spark, sf_dir):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    stated = spark.conf.get(key)
    spark.conf.unset(key)
    seen = []
    try:
        mart = Mart(spark, StandardTables(FX.fixture_teams(spark, sf_dir), FX.fixture_games(spark, sf_dir).selectExpr(
            "cast(game_id as string) game_id", "* except(game_id)")))
        mart.team_form()
        mart._memo("training_dataset", lambda: seen.append(spark.conf.get(key)) or mart.team_form())
    finally:
        spark.conf.set(key, stated)
    assert seen == ["false"]
