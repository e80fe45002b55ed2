"""Standings, head-to-head records and the lookups behind the matchup explorer.

Aggregations run on ids first and join the (small) team dimension afterwards,
so names are attached to already-reduced rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formmart.functions.labels import ratio_round
from formmart.operators.joins import small_side

def _W():
    return F.when(F.col("wl") == "W", 1).otherwise(0)


def _L():
    return F.when(F.col("wl") == "L", 1).otherwise(0)


def standings(games: DataFrame, teams: DataFrame) -> DataFrame:
    """Wins, losses and win share by (season, team name), best first within a season."""
    per_team = (games.groupBy("season", "team_id")
                     .agg(F.sum(_W()).alias("w"), F.sum(_L()).alias("l"), F.count(F.lit(1)).alias("n")))
    named = per_team.join(small_side(teams.select("team_id", F.col("full_name").alias("team_name"))), "team_id")
    agg = named.groupBy("season", "team_name").agg(
        F.sum("w").cast("bigint").alias("wins"), F.sum("l").cast("bigint").alias("losses"),
        F.sum("n").alias("games"))
    return (agg.select("season", "team_name", "wins", "losses",
                       ratio_round("wins", "games", 3).alias("win_pct"))
               .orderBy(F.col("season").desc(), F.col("win_pct").desc(), "team_name"))


def h2h_unordered(games: DataFrame, teams: DataFrame) -> DataFrame:
    """Record of each unordered pair, counting every team-game row of the pair.

    Both rows of a game are counted, so the rate sits near one half and is not
    "team_a's" record; kept as the source computes it.  See :func:`h2h_record_all`.
    """
    pairs = (games.select(F.least("team_id", "opponent_team_id").alias("t1"),
                          F.greatest("team_id", "opponent_team_id").alias("t2"), _W().alias("is_win"))
                  .groupBy("t1", "t2").agg(F.sum("is_win").alias("w"), F.count(F.lit(1)).alias("n")))
    a = small_side(teams.select(F.col("team_id").alias("t1"), F.col("full_name").alias("team_a")))
    b = small_side(teams.select(F.col("team_id").alias("t2"), F.col("full_name").alias("team_b")))
    agg = (pairs.join(a, "t1").join(b, "t2").groupBy("team_a", "team_b")
                .agg(F.sum("w").alias("w"), F.sum("n").alias("n")))
    return (agg.select("team_a", "team_b", F.col("w").cast("bigint").alias("wins_team_a_side"),
                       (F.col("n") - F.col("w")).cast("bigint").alias("losses_team_a_side"),
                       ratio_round("w", "n", 3).alias("winrate_team_a_side"))
               .orderBy(F.col("winrate_team_a_side").desc(), "team_a", "team_b"))


def h2h_record_all(games: DataFrame) -> DataFrame:
    """Ordered-pair record for every (team, opponent): games, wins, losses."""
    return (games.groupBy("team_id", "opponent_team_id")
                 .agg(F.count(F.lit(1)).alias("games_count"),
                      F.sum(_W()).cast("bigint").alias("team_a_wins"),
                      F.sum(_L()).cast("bigint").alias("team_a_losses")))


def h2h_record(games: DataFrame, team_a, team_b) -> DataFrame:
    """One-row record of team_a against team_b (zero games → count 0, null sums)."""
    return (games.where((F.col("team_id") == team_a) & (F.col("opponent_team_id") == team_b))
                 .agg(F.count(F.lit(1)).alias("games_count"),
                      F.sum(_W()).cast("bigint").alias("team_a_wins"),
                      F.sum(_L()).cast("bigint").alias("team_a_losses")))


def h2h_games(games: DataFrame, team_a, team_b) -> DataFrame:
    """team_a's games against team_b, newest first."""
    return (games.where((F.col("team_id") == team_a) & (F.col("opponent_team_id") == team_b))
                 .select("game_id", "game_date", "is_home", "wl")
                 .orderBy(F.col("game_date").desc(), "game_id"))


def busiest_pair(games: DataFrame) -> DataFrame:
    """The ordered pair with the most games (ties → smaller ids): one row (team_a, team_b)."""
    return (h2h_record_all(games).orderBy(F.col("games_count").desc(), "team_id", "opponent_team_id")
                                 .limit(1)
                                 .select(F.col("team_id").alias("team_a"),
                                         F.col("opponent_team_id").alias("team_b")))


def matchup_feature_rows(dataset: DataFrame, team_a: int, team_b: int) -> DataFrame:
    """Feature rows of both sides for every game between two teams; the ids reach the scan as a filter."""
    t, o = F.col("team_id"), F.col("opponent_team_id")
    return dataset.where(((t == team_a) & (o == team_b)) | ((t == team_b) & (o == team_a)))


def game_row(dataset: DataFrame, game_id, team_id: int) -> DataFrame:
    """The feature row of one side of one game."""
    return dataset.where((F.col("game_id") == game_id) & (F.col("team_id") == team_id))


def most_frequent_team(dataset: DataFrame) -> DataFrame:
    """Team with the most rows (ties → smaller id): one row (team_id)."""
    return (dataset.groupBy("team_id").count()
                   .orderBy(F.col("count").desc(), "team_id").limit(1).select("team_id"))


def form_series(form: DataFrame, team_id: int, first: int = 60, last: int = 20) -> DataFrame:
    """One team's first ``first`` form rows by date, of which the last ``last``."""
    cols = ["game_date", "game_id", "team_id", "wl", "pts", "pts_avg_l5", "winrate_l5", "tov", "tov_avg_l5"]
    head = form.where(F.col("team_id") == team_id).select(*cols).orderBy("game_date", "game_id").limit(first)
    return head.orderBy(F.col("game_date").desc(), F.col("game_id").desc()).limit(last)


def top_rows(df: DataFrame, order, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
