"""Standard tables and mart built from the driver's parquet tables (one per app)."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from formmart.plans.mart import Mart, StandardTables, materialize, write_table
from formmart.session import compile_in_parts, scratch_path
from formmart.sources import fixtures as FX

_MARTS: dict[tuple, Mart] = {}
_LOCK = threading.Lock()


def fixture_tables(spark: SparkSession, sf_dir: str, with_players: bool = True) -> StandardTables:
    """Standard tables of the adapter; the game tables are written once (CTAS)."""
    # in the session's codec: files are read in the order of their sizes, and with it the rows of an export that get positions as ids
    games_big = write_table(FX.fixture_games(spark, sf_dir), scratch_path(spark, "tables", "games"))
    games = games_big.withColumn("game_id", F.col("game_id").cast("string"))
    teams = FX.fixture_teams(spark, sf_dir)
    if not with_players:
        return StandardTables(teams=teams, games=games)
    pg = materialize(FX.fixture_player_games(spark, sf_dir, games_big), "player_games")
    pg = pg.withColumn("game_id", F.col("game_id").cast("string"))
    return StandardTables(teams=teams, games=games, players=FX.fixture_players(spark, sf_dir),
                          player_games=pg)


def mart_for(spark: SparkSession, sf_dir: str, with_players: bool = True) -> Mart:
    compile_in_parts(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), with_players)
    with _LOCK:
        if key not in _MARTS:
            if not with_players:
                full = mart_for_unlocked(spark, sf_dir)
                tables = StandardTables(teams=full.tables.teams, games=full.tables.games)
                base = Mart(spark, tables)
                # same games → same team form and base dataset: share the written tables
                base.adopt(full, ("team_form", "training_dataset"))
                _MARTS[key] = base
            else:
                _MARTS[key] = Mart(spark, fixture_tables(spark, sf_dir))
        return _MARTS[key]


def mart_for_unlocked(spark: SparkSession, sf_dir: str) -> Mart:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), True)
    if key not in _MARTS:
        _MARTS[key] = Mart(spark, fixture_tables(spark, sf_dir))
    return _MARTS[key]
