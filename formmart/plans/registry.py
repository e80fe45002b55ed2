"""Registered queries: name → callable(spark, sf_dir) -> DataFrame, plus DuckDB oracles.

Each query runs over the whole driver tables through the fixture adapter and
the mart.  Oracles restate the same result in SQL; keys without an oracle
(model fitting, files, catalog) get a row-count check only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formmart.functions.labels import quantize
from formmart.plans import oracle_sql as O
from formmart.plans.fixture_mart import mart_for
from formmart.plans.mart import Mart

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Quantize fractional averages (see ``oracle_sql.FRACTIONAL``) for comparison."""
    return df.select(*[quantize(c, digits).alias(c) if c in O.FRACTIONAL else F.col(c)
                       for c in df.columns])


def _view_sql(name: str, columns: list[str]) -> str:
    return O.with_views(O.rounded_select(name, columns))


# -- views -----------------------------------------------------------------

_GAMES_COLS = ["game_id", "season", "game_date", "team_id", "opponent_team_id", "is_home", "wl",
               "pts", "fg_pct", "fg3_pct", "ft_pct", "reb", "ast", "tov"]
_FORM_COLS = _GAMES_COLS + ["y_win", "rest_days", "pts_avg_l5", "reb_avg_l5", "ast_avg_l5", "tov_avg_l5",
                            "fg_pct_avg_l5", "fg3_pct_avg_l5", "ft_pct_avg_l5", "winrate_l5"]
_TEAM_F = ["rest_days", "pts_avg_l5", "reb_avg_l5", "ast_avg_l5", "tov_avg_l5", "fg_pct_avg_l5",
           "fg3_pct_avg_l5", "ft_pct_avg_l5", "winrate_l5"]
_STAR_F = ["star_pts_avg_l5_sum", "star_min_avg_l5_avg", "star_pm_avg_l5_avg"]
_DS_COLS = (["game_id", "season", "game_date", "team_id", "opponent_team_id", "is_home", "y_win"]
            + _TEAM_F + ["opp_" + c for c in _TEAM_F])
_ENR_COLS = _DS_COLS + _STAR_F + ["opp_" + c for c in _STAR_F]
_NAMED_HEAD = ["game_id", "season", "game_date", "is_home", "y_win", "team_name", "team_abbr",
               "opponent_name", "opponent_abbr"]
_NAMED_COLS = _NAMED_HEAD + _TEAM_F + ["opp_" + c for c in _TEAM_F] + ["team_id", "opponent_team_id"]
_ENR_NAMED_COLS = (_NAMED_HEAD + _TEAM_F + _STAR_F + ["opp_" + c for c in _TEAM_F + _STAR_F]
                   + ["team_id", "opponent_team_id"])
_PG_COLS = ["player_id", "game_id", "season", "game_date", "team_id", "opponent_team_id", "is_home", "wl",
            "minutes", "pts", "reb", "ast", "tov", "plus_minus", "fg_pct", "fg3_pct", "ft_pct", "stl", "blk", "pf"]


@register("v_games", _view_sql("v_games", _GAMES_COLS))
def q_v_games(spark, sf_dir):
    return mart_for(spark, sf_dir).v_games()


@register("v_teams", _view_sql("v_teams", ["team_id", "full_name", "abbreviation", "city", "state",
                                           "year_founded"]))
def q_v_teams(spark, sf_dir):
    return mart_for(spark, sf_dir).v_teams()


@register("v_player_games", _view_sql("v_player_games", _PG_COLS))
def q_v_player_games(spark, sf_dir):
    return mart_for(spark, sf_dir).v_player_games()


@register("v_players", _view_sql("v_players", ["player_id", "full_name", "first_name", "last_name",
                                               "is_active"]))
def q_v_players(spark, sf_dir):
    return mart_for(spark, sf_dir).v_players()


@register("v_team_form", _view_sql("v_team_form", _FORM_COLS))
def q_v_team_form(spark, sf_dir):
    return rounded(mart_for(spark, sf_dir).team_form())


@register("rest_days", O.with_views(
    "SELECT game_id, team_id, game_date, rest_days FROM v_team_form"))
def q_rest_days(spark, sf_dir):
    return mart_for(spark, sf_dir).team_form().select("game_id", "team_id", "game_date", "rest_days")


@register("v_training_dataset", _view_sql("v_training_dataset", _DS_COLS))
def q_v_training_dataset(spark, sf_dir):
    return rounded(mart_for(spark, sf_dir).training_dataset())


@register("v_player_form", _view_sql("v_player_form", _PG_COLS + ["min_avg_l5", "pts_avg_l5", "pm_avg_l5"]))
def q_v_player_form(spark, sf_dir):
    return rounded(mart_for(spark, sf_dir).player_form())


#: Events a window task may see in the ``*_large`` queries: every entity is hot.
FEW_EVENTS = 16


def _large(spark, sf_dir):
    """A mart of the same tables that divides every entity."""
    m = mart_for(spark, sf_dir)
    return m.memo("large", lambda: Mart(spark, m.tables, chunk_rows=FEW_EVENTS))


@register("v_team_form_large", _view_sql("v_team_form", _FORM_COLS))
def q_v_team_form_large(spark, sf_dir):
    return rounded(_large(spark, sf_dir).team_form())


@register("v_player_form_large", _view_sql("v_player_form", _PG_COLS + ["min_avg_l5", "pts_avg_l5", "pm_avg_l5"]))
def q_v_player_form_large(spark, sf_dir):
    return rounded(_large(spark, sf_dir).player_form())


@register("star_ranked", _view_sql("star_ranked", ["game_id", "team_id", "opponent_team_id", "game_date",
                                                   "player_id", "pts_avg_l5", "min_avg_l5", "pm_avg_l5", "rn"]))
def q_star_ranked(spark, sf_dir):
    from formmart.operators.features import star_ranked
    return rounded(star_ranked(mart_for(spark, sf_dir).player_form()))


@register("v_team_star_features", _view_sql("v_team_star_features",
                                            ["game_id", "team_id", "opponent_team_id", "game_date"] + _STAR_F))
def q_v_team_star_features(spark, sf_dir):
    return rounded(mart_for(spark, sf_dir).team_star_features())


@register("v_training_dataset_enriched", _view_sql("v_training_dataset_enriched", _ENR_COLS))
def q_v_training_dataset_enriched(spark, sf_dir):
    return rounded(mart_for(spark, sf_dir).training_dataset_enriched())


@register("v_training_dataset_named", _view_sql("v_training_dataset_named", _NAMED_COLS))
def q_v_training_dataset_named(spark, sf_dir):
    return rounded(mart_for(spark, sf_dir).training_dataset_named())


@register("v_training_dataset_enriched_named", _view_sql("v_training_dataset_enriched_named", _ENR_NAMED_COLS))
def q_v_training_dataset_enriched_named(spark, sf_dir):
    return rounded(mart_for(spark, sf_dir).training_dataset_enriched_named())


@register("opt_sources_base_only", _view_sql("v_training_dataset", _DS_COLS))
def q_opt_sources_base_only(spark, sf_dir):
    """Without player tables the dataset of choice is the base training dataset."""
    m = mart_for(spark, sf_dir, with_players=False)
    assert m.dataset_view == "v_training_dataset"
    return rounded(m.dataset())


# Register the remaining query families.
from formmart.plans import q_standardize  # noqa: E402,F401
from formmart.plans import q_analytics  # noqa: E402,F401
from formmart.plans import q_profile  # noqa: E402,F401
from formmart.plans import q_learning  # noqa: E402,F401
