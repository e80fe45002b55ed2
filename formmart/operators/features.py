"""The feature-mart views as DataFrame functions.

Each function corresponds to one named view of the mart and is a pure
``DataFrame -> DataFrame`` transformation; :mod:`formmart.plans.mart` wires them
together, registers them as temp views and decides what is materialized.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formmart import schemas as S
from formmart.operators.form import DEFAULT_CHUNK_ROWS, days_since_previous, rolling_form
from formmart.operators.joins import small_side

_D = "double"


def v_games(games: DataFrame) -> DataFrame:
    """Typed 14-column projection of the team-game table."""
    return games.select(
        "game_id", "season", F.col("game_date").cast("date").alias("game_date"),
        "team_id", "opponent_team_id", F.col("is_home").cast("boolean").alias("is_home"), "wl",
        *[F.col(c).cast(_D).alias(c) for c in ("pts", "fg_pct", "fg3_pct", "ft_pct", "reb", "ast", "tov")])


def v_teams(teams: DataFrame) -> DataFrame:
    return teams.select("team_id", "full_name", "abbreviation", "city", "state", "year_founded")


def v_player_games(player_games: DataFrame) -> DataFrame:
    return player_games.select(
        "player_id", "game_id", "season", F.col("game_date").cast("date").alias("game_date"),
        "team_id", "opponent_team_id", F.col("is_home").cast("boolean").alias("is_home"), "wl",
        *[F.col(c).cast(_D).alias(c) for c in ("minutes", "pts", "reb", "ast", "tov", "plus_minus",
                                              "fg_pct", "fg3_pct", "ft_pct", "stl", "blk", "pf")])


def v_players(players: DataFrame) -> DataFrame:
    return players.select("player_id", "full_name", "first_name", "last_name", "is_active")


def win_flag(wl: str = "wl"):
    """1 for a win, 0 otherwise (null or any other text counts as not won)."""
    return F.when(F.col(wl) == "W", 1).otherwise(0)


def team_form(games: DataFrame, n: int = 5, metrics: Sequence[tuple[str, str]] = S.TEAM_FORM_METRICS,
              chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """One row per team-game with label, rest days and last-n means (current game excluded).

    Window order is (game_date, game_id): same-day games of a team get a
    deterministic order.  Form carries across seasons, as in the source.
    """
    g = v_games(games).withColumn("y_win", win_flag())
    return rolling_form(
        g, "team_id", metrics, n=n, chunk_rows=chunk_rows,
        extra={"rest_days": days_since_previous("game_date"),
               "winrate_l5": (lambda w: F.avg(win_flag()).over(w.rowsBetween(-n, -1)))},
    ).select(*g.columns, "rest_days", *[o for _, o in metrics], "winrate_l5")


def opponent_join(form: DataFrame, features: Sequence[str] = S.TEAM_FEATURES,
                  keys: Sequence[str] = S.DATASET_KEYS, prefix: str = "opp_",
                  require: Sequence[str] = ("pts_avg_l5", "winrate_l5")) -> DataFrame:
    """Team features + the opponent's features for the same game, one row per team-game.

    Inner equi-join on (game_id, opponent_team_id) = (game_id, team_id); rows
    lacking any form (team or opponent) for the ``require`` columns are dropped.
    """
    a = form.select(*keys, *features)
    b = form.select(F.col("game_id").alias("_b_game"), F.col("team_id").alias("_b_team"),
                    *[F.col(c).alias(prefix + c) for c in features])
    joined = a.join(b, (a.game_id == b._b_game) & (a.opponent_team_id == b._b_team))
    cond = None
    for c in require:
        for name in (c, prefix + c):
            term = F.col(name).isNotNull()
            cond = term if cond is None else cond & term
    return joined.where(cond).select(*keys, *features, *[prefix + c for c in features])


def player_form(player_games: DataFrame, n: int = 5,
                metrics: Sequence[tuple[str, str]] = S.PLAYER_FORM_METRICS,
                chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    pg = v_player_games(player_games)
    return rolling_form(pg, "player_id", metrics, n=n, chunk_rows=chunk_rows).select(
        *pg.columns, *[o for _, o in metrics])


def star_ranked(pform: DataFrame, top: int = 3, rank_by: str = "pts_avg_l5") -> DataFrame:
    """Top ``top`` players of each team-game by pre-game form (nulls last, ties by player_id).

    ``row_number() <= k`` is planned with a partial per-partition group limit
    before the shuffle, so a huge team-game never reaches one task whole.
    """
    w = Window.partitionBy("game_id", "team_id").orderBy(F.col(rank_by).desc_nulls_last(), "player_id")
    return (pform.select("game_id", "team_id", "opponent_team_id", "game_date", "player_id",
                         "pts_avg_l5", "min_avg_l5", "pm_avg_l5",
                         F.row_number().over(w).alias("rn"))
                 .where(F.col("rn") <= top))


def team_star_features(pform: DataFrame, top: int = 3) -> DataFrame:
    return (star_ranked(pform, top)
            .groupBy("game_id", "team_id", "opponent_team_id", "game_date")
            .agg(F.sum("pts_avg_l5").alias("star_pts_avg_l5_sum"),
                 F.avg("min_avg_l5").alias("star_min_avg_l5_avg"),
                 F.avg("pm_avg_l5").alias("star_pm_avg_l5_avg")))


def enrich(base: DataFrame, stars: DataFrame, prefix: str = "opp_") -> DataFrame:
    """Left-join own and opponent star features onto the base dataset, by one join.

    The star rows of a game (its teams' aggregates, a few) become one array, and
    each dataset row picks those of its own team and of its opponent; a team that
    has several rows in a game gives a row for each, as two left joins would.
    Tables bucketed by game are joined and grouped without an exchange.
    """
    side = F.struct(F.col("team_id"), *S.STAR_FEATURES)
    per_game = (stars.where(F.col("team_id").isNotNull()).groupBy(F.col("game_id").alias("_g_game"))
                     .agg(F.collect_list(side).alias("_sides")))
    joined = base.join(per_game, base.game_id == per_game._g_game, "left")

    def of(team: str):
        return F.filter("_sides", lambda s: s["team_id"] == F.col(team))

    own = joined.withColumn("_own", F.explode_outer(of("team_id")))
    both = own.withColumn("_opp", F.explode_outer(of("opponent_team_id")))
    return both.select(*base.columns, *[F.col("_own").getField(c).alias(c) for c in S.STAR_FEATURES],
                       *[F.col("_opp").getField(c).alias(prefix + c) for c in S.STAR_FEATURES])


def with_names(dataset: DataFrame, teams: DataFrame, enriched: bool = False) -> DataFrame:
    """Readable view: names and abbreviations first, numeric features, ids last.

    The team dimension is joined twice (own side, opponent side), broadcast
    when its measured size fits (see :mod:`formmart.operators.joins`).
    """
    t = v_teams(teams)
    own = small_side(t.select(F.col("team_id").alias("_t_id"), F.col("full_name").alias("team_name"),
                              F.col("abbreviation").alias("team_abbr")))
    opp = small_side(t.select(F.col("team_id").alias("_o_id"), F.col("full_name").alias("opponent_name"),
                              F.col("abbreviation").alias("opponent_abbr")))
    d = (dataset.join(own, dataset.team_id == own._t_id)
                .join(opp, dataset.opponent_team_id == opp._o_id))
    team = list(S.TEAM_FEATURES) + (list(S.STAR_FEATURES) if enriched else [])
    return d.select("game_id", "season", "game_date", "is_home", "y_win",
                    "team_name", "team_abbr", "opponent_name", "opponent_abbr",
                    *team, *["opp_" + c for c in team], "team_id", "opponent_team_id")
