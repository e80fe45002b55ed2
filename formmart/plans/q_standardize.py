"""Registered queries for sources, standardization, sinks and parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from formmart import schemas as S
from formmart.functions import parse as P
from formmart.operators import standardize as STD
from formmart.plans.fixture_mart import mart_for
from formmart.plans.mart import materialize, write_table
from formmart.plans.oracle_sql import with_views
from formmart.plans.registry import _ENR_COLS, _view_sql, register
from formmart.session import deleted, scratch_path
from formmart.sources import csv as CSV
from formmart.sources import raw_render as R

_G = ", ".join(S.GAMES_COLUMNS)
_PG = ", ".join(S.PLAYER_GAMES_COLUMNS)
CLEAN_GAMES = with_views(f"SELECT {_G} FROM games")
CLEAN_PG = with_views(f"SELECT {_PG} FROM player_games")


def _tables(spark, sf_dir):
    return mart_for(spark, sf_dir).tables


def raw_games(spark, sf_dir):
    """The games export with a matchup text, rendered and written once per mart."""
    m = mart_for(spark, sf_dir)
    return m.memo("raw_games", lambda: materialize(R.raw_games_matchup(m.tables.games, m.tables.teams), "raw_games"))


def raw_player_games(spark, sf_dir):
    m = mart_for(spark, sf_dir)
    return m.memo("raw_player_games", lambda: materialize(
        R.raw_player_games(m.tables.player_games, m.tables.teams), "raw_player_games"))


@register("std_norm_cols", with_views(
    "SELECT lpad(CAST(team_id AS VARCHAR), 10, '0') AS id, full_name, abbreviation, full_name AS nickname, "
    "city, state, '' AS year_founded FROM teams"))
def q_std_norm_cols(spark, sf_dir):
    return STD.norm_cols(R.raw_teams(_tables(spark, sf_dir).teams))


@register("std_teams", with_views(
    "SELECT team_id, full_name, abbreviation, city, state, year_founded FROM teams"))
def q_std_teams(spark, sf_dir):
    return STD.standardize_teams(R.raw_teams(_tables(spark, sf_dir).teams))


@register("std_players", with_views(
    "SELECT player_id, full_name, first_name, last_name, is_active FROM players"))
def q_std_players(spark, sf_dir):
    return STD.standardize_players(R.raw_players(_tables(spark, sf_dir).players))


@register("std_games_matchup", CLEAN_GAMES)
def q_std_games_matchup(spark, sf_dir):
    return STD.standardize_games(raw_games(spark, sf_dir), _tables(spark, sf_dir).teams)


@register("std_games_oppid", CLEAN_GAMES)
def q_std_games_oppid(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return STD.standardize_games(R.raw_games_oppid(t.games), t.teams)


@register("std_games_dropna", CLEAN_GAMES)
def q_std_games_dropna(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return STD.standardize_games(R.raw_games_oppid(t.games, missing_keys=True), t.teams)


@register("std_missing_cols", with_views(
    "SELECT game_id, season, game_date, team_id, opponent_team_id, FALSE AS is_home, wl, "
    + ", ".join(f"CAST(NULL AS DOUBLE) AS {s}" for s in S.GAME_STATS) + " FROM games"))
def q_std_missing_cols(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return STD.standardize_games(R.raw_games_oppid(t.games, with_home=False, with_stats=False), t.teams)


@register("std_games_no_id")
def q_std_games_no_id(spark, sf_dir):
    """No game id column: rows get a synthetic 0-based position as their id."""
    t = _tables(spark, sf_dir)
    return STD.standardize_games(R.raw_games_oppid(t.games, junk=False).drop("game_id"), t.teams)


@register("std_player_games", CLEAN_PG)
def q_std_player_games(spark, sf_dir):
    return STD.standardize_player_games(raw_player_games(spark, sf_dir), _tables(spark, sf_dir).teams)


@register("fn_season_fallback", CLEAN_GAMES)
def q_fn_season_fallback(spark, sf_dir):
    """Season column present but empty everywhere → derived from the date."""
    t = _tables(spark, sf_dir)
    return STD.standardize_games(R.raw_games_matchup(t.games, t.teams, season="empty"), t.teams)


@register("src_csv_roundtrip", CLEAN_GAMES)
def q_src_csv_roundtrip(spark, sf_dir):
    """Raw games written as CSV text, scanned back as all-string columns, standardized."""
    t = _tables(spark, sf_dir)
    path = CSV.write_raw_csv(R.raw_games_matchup(t.games, t.teams), scratch_path(spark, "csv", "games"))
    return STD.standardize_games(CSV.read_raw_csv(spark, path), t.teams)


@register("sink_table_replace", CLEAN_GAMES)
def q_sink_table_replace(spark, sf_dir):
    """Replace semantics: the whole table written twice leaves exactly one copy of the rows."""
    g = _tables(spark, sf_dir).games
    path = scratch_path(spark, "tables", "games_replace")
    write_table(g, path)
    return write_table(g, path)


@register("std_games_rejected", with_views(
    "SELECT CASE (CAST(game_id AS BIGINT) + team_id) % 3 WHEN 0 THEN 'game_date' WHEN 1 THEN 'matchup' "
    "ELSE 'opponent_abbreviation' END AS reject_reason, count(*) AS \"rows\" FROM games GROUP BY 1"))
def q_std_games_rejected(spark, sf_dir):
    """Rows that the games export loses, by reason."""
    t = _tables(spark, sf_dir)
    return STD.rejects(STD.games_with_reasons(R.raw_games_matchup(t.games, t.teams), t.teams))


@register("std_player_games_rejected", with_views(
    "SELECT CASE (CAST(game_id AS BIGINT) + team_id) % 4 WHEN 0 THEN 'game_date' WHEN 1 THEN 'team_abbreviation' "
    "WHEN 2 THEN 'matchup' ELSE 'opponent_abbreviation' END AS reject_reason, count(*) AS \"rows\" "
    "FROM player_games GROUP BY 1"))
def q_std_player_games_rejected(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return STD.rejects(STD.player_games_with_reasons(R.raw_player_games(t.player_games, t.teams), t.teams))


@register("std_build_rejected", with_views(
    "SELECT 'games' AS source, CASE (CAST(game_id AS BIGINT) + team_id) % 3 WHEN 0 THEN 'game_date' WHEN 1 THEN 'matchup' "
    "ELSE 'opponent_abbreviation' END AS reject_reason, count(*) AS \"rows\" FROM games GROUP BY 2"))
def q_std_build_rejected(spark, sf_dir):
    """Dropped rows as observed while the tables are built from CSV text."""
    t = _tables(spark, sf_dir)
    base = scratch_path(spark, "csv", "rejects")
    std = CSV.build_standard_tables(spark, CSV.write_raw_csv(R.raw_teams(t.teams), f"{base}/teams"),
                                    CSV.write_raw_csv(R.raw_games_matchup(t.games, t.teams), f"{base}/games"))
    rows = [(table, reason, n) for table, reasons in std.rejected.items() for reason, n in reasons.items()]
    return spark.createDataFrame(rows, "source string, reject_reason string, rows bigint")


@register("std_row_positions", with_views(
    "SELECT CAST(range AS VARCHAR) AS game_id FROM range((SELECT count(*) FROM games))"))
def q_std_row_positions(spark, sf_dir):
    """Synthetic ids of an export without ids, read from CSV text and shuffled before and after: dense from 0."""
    t = _tables(spark, sf_dir)
    raw = R.raw_games_oppid(t.games, junk=False).drop("game_id")
    path = CSV.write_raw_csv(raw.repartition("date"), scratch_path(spark, "csv", "no_id"))
    return STD.standardize_games(CSV.read_raw_csv(spark, path), t.teams).repartition("team_id").select("game_id")


# -- parsers ------------------------------------------------------------------

def _k(n, other="team_id"):
    return F.pmod(F.col("game_id").cast("bigint") + F.col(other), F.lit(n))


def _k_sql(n, other="team_id"):
    return f"((CAST(game_id AS BIGINT) + {other}) % {n})"


@register("fn_to_numeric", with_views(
    f"SELECT game_id, team_id, CASE WHEN {_k_sql(4)} = 3 THEN NULL ELSE pts END AS pts_value, "
    f"CASE WHEN {_k_sql(4)} = 3 THEN NULL ELSE fg_pct END AS fg_pct_value FROM games"))
def q_fn_to_numeric(spark, sf_dir):
    k = _k(4)
    g = _tables(spark, sf_dir).games
    pts_txt = (F.when(k == 0, F.col("pts").cast("string"))
                .when(k == 1, F.concat(F.lit("  "), F.col("pts").cast("string"), F.lit(" ")))
                .when(k == 2, F.col("pts").cast("bigint").cast("string"))
                .otherwise(F.lit("n/a")))
    fg_txt = F.when(k == 3, F.lit("NaN")).otherwise(F.col("fg_pct").cast("string"))
    return g.select("game_id", "team_id", P.to_numeric(pts_txt).alias("pts_value"),
                    P.to_numeric(fg_txt).alias("fg_pct_value"))


@register("fn_parse_date", with_views(
    f"SELECT game_id, team_id, CASE WHEN {_k_sql(7)} = 6 THEN NULL ELSE game_date END AS parsed "
    "FROM games"))
def q_fn_parse_date(spark, sf_dir):
    g = R.with_style(_tables(spark, sf_dir).games)
    txt = F.when(_k(7) == 6, F.lit("not a date")).otherwise(R.date_text())
    return g.select("game_id", "team_id", P.parse_date(txt).alias("parsed"))


@register("fn_season", with_views(
    "SELECT game_id, team_id, game_date, CAST(year(game_date) - CASE WHEN month(game_date) < 10 THEN 1 ELSE 0 END "
    "AS BIGINT) AS season FROM games"))
def q_fn_season(spark, sf_dir):
    g = _tables(spark, sf_dir).games
    return g.select("game_id", "team_id", "game_date", P.season_start("game_date").alias("season"))


@register("fn_matchup", with_views(
    f"SELECT g.game_id, g.team_id, CASE WHEN {_k_sql(6, 'g.team_id').replace('game_id', 'g.game_id')} >= 3 "
    "THEN NULL ELSE upper(t.abbreviation) END AS team_abbr, "
    f"CASE WHEN {_k_sql(6, 'g.team_id').replace('game_id', 'g.game_id')} >= 3 "
    "THEN NULL ELSE upper(o.abbreviation) END AS opp_abbr, "
    f"CASE WHEN {_k_sql(6, 'g.team_id').replace('game_id', 'g.game_id')} >= 3 THEN NULL ELSE g.is_home END "
    "AS is_home FROM games g JOIN teams t ON t.team_id = g.team_id JOIN teams o ON o.team_id = g.opponent_team_id"))
def q_fn_matchup(spark, sf_dir):
    t = _tables(spark, sf_dir)
    g = R._abbr(R._abbr(t.games, t.teams, "team_id", "_t"), t.teams, "opponent_team_id", "_o")
    k = _k(6)
    sep = F.when(F.col("is_home"), F.lit(" vs. ")).otherwise(F.lit(" @ "))
    txt = (F.when(k == 0, F.concat(F.col("_t"), sep, F.col("_o")))
            .when(k == 1, F.concat(F.lower(F.col("_t")),
                                   F.when(F.col("is_home"), F.lit("  VS.  ")).otherwise(F.lit("   @  ")),
                                   F.lower(F.col("_o"))))
            .when(k == 2, F.concat(F.lit("  "), F.col("_t"),
                                   F.when(F.col("is_home"), F.lit(" vs ")).otherwise(F.lit("\t@ ")),
                                   F.col("_o"), F.lit(" ")))
            .when(k == 3, F.concat(F.col("_t"), F.lit(" - "), F.col("_o")))
            .when(k == 4, F.col("_t"))
            .otherwise(F.concat(F.col("_t"), F.lit(" at "), F.col("_o"))))
    m = P.parse_matchup(txt)
    return g.select("game_id", "team_id", m.getField("team").alias("team_abbr"),
                    m.getField("opponent").alias("opp_abbr"), m.getField("is_home").alias("is_home"))


@register("fn_minutes", with_views(
    f"SELECT player_id, game_id, CASE {_k_sql(6, 'player_id')} WHEN 0 THEN minutes WHEN 1 THEN minutes "
    "WHEN 2 THEN minutes + 0.5 ELSE NULL END AS minutes FROM player_games"))
def q_fn_minutes(spark, sf_dir):
    pg = _tables(spark, sf_dir).player_games
    k = _k(6, "player_id")
    whole = F.col("minutes").cast("bigint").cast("string")
    txt = (F.when(k == 0, F.concat(whole, F.lit(":00")))
            .when(k == 1, F.col("minutes").cast("string"))
            .when(k == 2, F.concat(whole, F.lit(":30")))
            .when(k == 3, F.lit("x:10"))
            .when(k == 4, F.lit("1:2:3"))
            .otherwise(F.lit("")))
    return pg.select("player_id", "game_id", P.parse_minutes(txt).alias("minutes"))


@register("csv_to_dataset", _view_sql("v_training_dataset_enriched", _ENR_COLS))
def q_csv_to_dataset(spark, sf_dir):
    """Whole build from raw CSV text files: four exports → standard tables → enriched dataset."""
    from formmart.plans.mart import Mart
    from formmart.plans.registry import rounded
    t = _tables(spark, sf_dir)
    base = scratch_path(spark, "csv", "exports")
    paths = {
        "teams": CSV.write_raw_csv(R.raw_teams(t.teams), f"{base}/teams"),
        "games": CSV.write_raw_csv(R.raw_games_matchup(t.games, t.teams), f"{base}/games"),
        "players": CSV.write_raw_csv(R.raw_players(t.players), f"{base}/players"),
        "player_games": CSV.write_raw_csv(R.raw_player_games(t.player_games, t.teams), f"{base}/player_games"),
    }
    std = CSV.build_standard_tables(spark, paths["teams"], paths["games"], paths["players"], paths["player_games"])
    deleted(spark, base)  # the standard tables are written: nothing reads the exports again
    return rounded(Mart(spark, std).dataset())
