"""Registered queries: standings, head-to-head, samples, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from formmart.functions import labels as LB
from formmart.functions.labels import quantize_sql
from formmart.operators import analytics as A
from formmart.plans.fixture_mart import mart_for
from formmart.plans.oracle_sql import with_views
from formmart.plans.registry import register, rounded

WIN = "CASE WHEN wl = 'W' THEN 1 ELSE 0 END"
LOSS = "CASE WHEN wl = 'L' THEN 1 ELSE 0 END"


def ratio_sql(num: str, den: str, digits: int = 3) -> str:
    s = 10 ** digits
    return f"CAST((2 * {s} * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / {s}"


PAIR = ("meetings AS (SELECT team_id AS team_a, opponent_team_id AS team_b, count(*) AS n FROM v_games GROUP BY ALL), "
        "pair AS (SELECT team_a, team_b FROM meetings ORDER BY n DESC, team_a, team_b LIMIT 1)")


@register("standings", with_views(
    f", results AS (SELECT season, team_id, {WIN} AS w, {LOSS} AS l FROM v_games) "
    "SELECT season, full_name AS team_name, CAST(sum(w) AS BIGINT) AS wins, CAST(sum(l) AS BIGINT) AS losses, "
    f"{ratio_sql('sum(w)', 'count(*)')} AS win_pct "
    "FROM results JOIN v_teams USING (team_id) GROUP BY season, full_name"))
def q_standings(spark, sf_dir):
    m = mart_for(spark, sf_dir)
    return A.standings(m.v_games(), m.v_teams())


@register("h2h_unordered", with_views(
    f", met AS (SELECT list_sort([team_id, opponent_team_id]) AS ids, {WIN} AS w FROM v_games), "
    "per_pair AS (SELECT ids, sum(w) AS w, count(*) AS n FROM met GROUP BY ids) "
    "SELECT x.full_name AS team_a, y.full_name AS team_b, CAST(sum(w) AS BIGINT) AS wins_team_a_side, "
    "CAST(sum(n) - sum(w) AS BIGINT) AS losses_team_a_side, "
    f"{ratio_sql('sum(w)', 'sum(n)')} AS winrate_team_a_side "
    "FROM per_pair JOIN v_teams x ON x.team_id = ids[1] JOIN v_teams y ON y.team_id = ids[2] GROUP BY ALL"))
def q_h2h_unordered(spark, sf_dir):
    m = mart_for(spark, sf_dir)
    return A.h2h_unordered(m.v_games(), m.v_teams())


_TALLY = ("count(*) AS games_count, CAST(sum(CAST(wl = 'W' AS INTEGER)) AS BIGINT) AS team_a_wins, "
          "CAST(sum(CAST(wl = 'L' AS INTEGER)) AS BIGINT) AS team_a_losses")


@register("h2h_record_all", with_views(f"SELECT team_id, opponent_team_id, {_TALLY} FROM v_games GROUP BY ALL"))
def q_h2h_record_all(spark, sf_dir):
    return A.h2h_record_all(mart_for(spark, sf_dir).v_games())


def _pair(spark, sf_dir):
    row = A.busiest_pair(mart_for(spark, sf_dir).v_games()).first()
    return row["team_a"], row["team_b"]


@register("h2h_record", with_views(
    f", {PAIR} SELECT {_TALLY} FROM v_games WHERE (team_id, opponent_team_id) = (SELECT (team_a, team_b) FROM pair)"))
def q_h2h_record(spark, sf_dir):
    a, b = _pair(spark, sf_dir)
    return A.h2h_record(mart_for(spark, sf_dir).v_games(), a, b)


@register("h2h_games", with_views(
    f", {PAIR} SELECT game_id, game_date, is_home, wl FROM v_games g JOIN pair "
    "ON g.team_id = pair.team_a AND g.opponent_team_id = pair.team_b"))
def q_h2h_games(spark, sf_dir):
    a, b = _pair(spark, sf_dir)
    return A.h2h_games(mart_for(spark, sf_dir).v_games(), a, b)


_ENR = ("game_id, season, game_date, team_id, opponent_team_id, is_home, y_win, rest_days, pts_avg_l5, reb_avg_l5, "
        "ast_avg_l5, tov_avg_l5, fg_pct_avg_l5, fg3_pct_avg_l5, ft_pct_avg_l5, winrate_l5, opp_rest_days, "
        "opp_pts_avg_l5, opp_reb_avg_l5, opp_ast_avg_l5, opp_tov_avg_l5, opp_fg_pct_avg_l5, opp_fg3_pct_avg_l5, "
        "opp_ft_pct_avg_l5, opp_winrate_l5, star_pts_avg_l5_sum, star_min_avg_l5_avg, star_pm_avg_l5_avg, "
        "opp_star_pts_avg_l5_sum, opp_star_min_avg_l5_avg, opp_star_pm_avg_l5_avg").split(", ")


def _rsel(cols, alias="d"):
    from formmart.plans.oracle_sql import FRACTIONAL
    return ", ".join(f"{quantize_sql(alias + '.' + c)} AS {c}" if c in FRACTIONAL else f"{alias}.{c}"
                     for c in cols)


@register("matchup_feature_rows", with_views(
    f", {PAIR} SELECT {_rsel(_ENR)} FROM v_training_dataset_enriched d JOIN pair "
    "ON (d.team_id = pair.team_a AND d.opponent_team_id = pair.team_b) "
    "OR (d.team_id = pair.team_b AND d.opponent_team_id = pair.team_a)"))
def q_matchup_feature_rows(spark, sf_dir):
    m = mart_for(spark, sf_dir)
    return rounded(A.matchup_feature_rows(m.dataset(), *_pair(spark, sf_dir)))


@register("game_row", with_views(
    f"SELECT {_rsel(_ENR)} FROM v_training_dataset_enriched d ORDER BY d.game_date, d.game_id, d.team_id LIMIT 1"))
def q_game_row(spark, sf_dir):
    """Point lookup by (game, team): the first row of the dataset, found by its key."""
    ds = mart_for(spark, sf_dir).dataset()
    key = ds.orderBy("game_date", "game_id", "team_id").select("game_id", "team_id").first()
    return rounded(A.game_row(ds, key.game_id, key.team_id) if key else ds.limit(0))


@register("leakage_series", with_views(
    ", top_team AS (SELECT team_id FROM v_training_dataset_enriched GROUP BY team_id "
    "ORDER BY count(*) DESC, team_id LIMIT 1), "
    "head AS (SELECT game_date, game_id, f.team_id, wl, pts, pts_avg_l5, winrate_l5, tov, tov_avg_l5 "
    "FROM v_team_form f JOIN top_team USING (team_id) ORDER BY game_date, game_id LIMIT 60) "
    f"SELECT {_rsel(['game_date', 'game_id', 'team_id', 'wl', 'pts', 'pts_avg_l5', 'winrate_l5', 'tov', 'tov_avg_l5'], 'h')} "
    "FROM (SELECT * FROM head ORDER BY game_date DESC, game_id DESC LIMIT 20) h"))
def q_leakage_series(spark, sf_dir):
    m = mart_for(spark, sf_dir)
    team = A.most_frequent_team(m.dataset()).first()[0]
    return rounded(A.form_series(m.team_form(), team))


@register("teams_sample", with_views("SELECT * FROM v_teams ORDER BY team_id LIMIT 10"))
def q_teams_sample(spark, sf_dir):
    return A.top_rows(mart_for(spark, sf_dir).v_teams(), ["team_id"], 10)


@register("games_sample", with_views(
    "SELECT * FROM v_games ORDER BY game_date DESC, game_id, team_id LIMIT 10"))
def q_games_sample(spark, sf_dir):
    return A.top_rows(mart_for(spark, sf_dir).v_games(),
                      [F.col("game_date").desc(), "game_id", "team_id"], 10)


@register("named_preview", with_views(
    "SELECT game_date, team_abbr, opponent_abbr, is_home, y_win FROM v_training_dataset_enriched_named "
    "ORDER BY game_date DESC, game_id, team_id LIMIT 15"))
def q_named_preview(spark, sf_dir):
    named = mart_for(spark, sf_dir).named_dataset()
    return (A.top_rows(named, [F.col("game_date").desc(), "game_id", "team_id"], 15)
            .select("game_date", "team_abbr", "opponent_abbr", "is_home", "y_win"))


@register("dataset_head", with_views(
    f"SELECT {_rsel(_ENR)} FROM (SELECT * FROM v_training_dataset_enriched "
    "ORDER BY game_date, game_id, team_id LIMIT 5) d"))
def q_dataset_head(spark, sf_dir):
    return rounded(A.top_rows(mart_for(spark, sf_dir).dataset(), ["game_date", "game_id", "team_id"], 5))


@register("team_labels", with_views(
    "SELECT team_id, concat(coalesce(full_name, 'None'), ' (', coalesce(abbreviation, 'None'), ')') AS label "
    "FROM v_teams"))
def q_team_labels(spark, sf_dir):
    t = mart_for(spark, sf_dir).v_teams()
    return t.orderBy("full_name", "team_id").select("team_id", LB.team_label().alias("label"))


@register("game_labels", with_views(
    "SELECT game_id, team_id, concat(strftime(game_date, '%Y-%m-%d'), ' — ', "
    "CASE WHEN is_home THEN 'Home' ELSE 'Away' END, ' — Result: ', coalesce(upper(trim(wl)), 'NONE'), "
    "' — game_id=', game_id) AS label FROM v_games"))
def q_game_labels(spark, sf_dir):
    g = mart_for(spark, sf_dir).v_games()
    return g.select("game_id", "team_id", LB.game_label().alias("label"))


@register("matchup_titles", with_views(
    "SELECT game_id, team_id, concat(team_name, ' (', team_abbr, ')', CASE WHEN is_home THEN ' vs ' ELSE ' @ ' END, "
    "opponent_name, ' (', opponent_abbr, ')') AS title FROM v_training_dataset_enriched_named"))
def q_matchup_titles(spark, sf_dir):
    n = mart_for(spark, sf_dir).named_dataset()
    return n.select("game_id", "team_id", LB.matchup_title("team_name", "team_abbr", "opponent_name",
                                                           "opponent_abbr", "is_home").alias("title"))
