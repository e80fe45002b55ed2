"""Catalog registration: views serve plain SQL; stale player views are dropped."""

from formmart.plans.fixture_mart import mart_for
from formmart.plans.mart import Mart, StandardTables


def test_views_serve_sql(spark, sf_dir):
    m = mart_for(spark, sf_dir)
    names = m.register_views()
    assert "v_training_dataset_enriched_named" in names
    rows = spark.sql("""
        SELECT season, t.full_name AS team_name,
               SUM(CASE WHEN wl = 'W' THEN 1 ELSE 0 END) AS wins, COUNT(*) AS n
        FROM v_games g JOIN v_teams t ON t.team_id = g.team_id
        GROUP BY 1, 2""").collect()
    assert rows and all(0 <= r.wins <= r.n for r in rows)
    pair = spark.sql("SELECT team_id, opponent_team_id FROM v_games LIMIT 1").first()
    rec = spark.sql("SELECT COUNT(*) AS c FROM v_games WHERE team_id = :a AND opponent_team_id = :b",
                    args={"a": pair.team_id, "b": pair.opponent_team_id}).first()
    assert rec.c >= 1


def test_base_only_mart_drops_player_views(spark, sf_dir):
    full = mart_for(spark, sf_dir)
    full.register_views()
    base = Mart(spark, StandardTables(teams=full.tables.teams, games=full.tables.games))
    names = base.register_views()
    assert base.dataset_view == "v_training_dataset"
    assert "v_training_dataset_enriched" not in names
    assert not spark.catalog.tableExists("v_training_dataset_enriched")
    assert spark.catalog.tableExists("v_training_dataset_named")


def test_register_missing_views_keeps_existing(spark, sf_dir):
    m = mart_for(spark, sf_dir)
    for name in Mart.VIEW_NAMES:
        spark.catalog.dropTempView(name)
    spark.sql("SELECT 1 AS marker").createOrReplaceTempView("v_teams")
    created = m.register_missing_views()
    assert "v_teams" not in created and "v_games" in created
    assert spark.table("v_teams").columns == ["marker"]
    m.register_views()  # replace semantics restore the real view
    assert "team_id" in spark.table("v_teams").columns

