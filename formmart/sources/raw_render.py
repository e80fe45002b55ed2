"""Render clean standard tables back into messy raw text, for standardization checks.

Every clean row is rendered (in one of several spellings chosen by a
deterministic style number) and, where ``junk`` is set, every row also gets a
broken twin — unreadable date, broken matchup, unknown abbreviation or missing
key — that standardization must drop.  Standardizing the result therefore
must give back exactly the clean table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formmart.operators.joins import small_side

_S = "string"


_STYLE = "_fm_style"


def with_style(df: DataFrame, other: str = "team_id") -> DataFrame:
    """Add the per-row style number once (not re-derived inside every CASE branch)."""
    return df.withColumn(_STYLE, F.col("game_id").cast("bigint") + F.col(other))


def style(n: int) -> Column:
    """Deterministic spelling selector: (game id + team id) mod n; needs :func:`with_style`."""
    return F.pmod(F.col(_STYLE), F.lit(n))


def padded(c: str, width: int = 10) -> Column:
    return F.lpad(F.col(c).cast(_S), width, "0")


def date_text(c: str = "game_date") -> Column:
    k = style(9)
    d = F.col(c)
    return (F.when(k == 5, F.date_format(d, "MMMM d, yyyy"))
             .when(k == 6, F.date_format(d, "d MMM yyyy"))
             .when(k == 7, F.concat(F.lit("\u00a0"), F.date_format(d, "yyyy/MM/dd"), F.lit("\t")))
             .when(k == 8, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
             .when(k == 0, F.date_format(d, "yyyy-MM-dd"))
             .when(k == 1, F.date_format(d, "MMM dd, yyyy"))
             .when(k == 2, F.upper(F.date_format(d, "MMM dd, yyyy")))
             .when(k == 3, F.date_format(d, "MM/dd/yyyy"))
             .otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss")))


def wl_text(c: str = "wl") -> Column:
    k = style(3)
    return (F.when(k == 0, F.lower(F.col(c)))
             .when(k == 1, F.concat(F.lit(" "), F.lower(F.col(c)), F.lit("\u2003")))
             .otherwise(F.col(c)))


def num_text(c: str) -> Column:
    return F.col(c).cast(_S)


def _abbr(df: DataFrame, teams: DataFrame, id_col: str, out: str) -> DataFrame:
    t = small_side(teams.select(F.col("team_id").alias(f"_{out}_id"), F.col("abbreviation").alias(out)))
    return df.join(t, df[id_col] == t[f"_{out}_id"], "left").drop(f"_{out}_id")


def matchup_text(team: str = "_t_abbr", opp: str = "_o_abbr", home: str = "is_home") -> Column:
    k = style(3)
    vs = F.when(k == 2, F.lit("  VS.  ")).otherwise(F.lit(" vs. "))
    team_c = F.when(k == 1, F.lower(F.col(team))).otherwise(F.col(team))
    return F.when(F.col(home), F.concat(team_c, vs, F.col(opp))).otherwise(
        F.concat(team_c, F.lit(" @ "), F.col(opp)))


def raw_teams(teams: DataFrame) -> DataFrame:
    return teams.select(
        F.lpad(F.col("team_id").cast(_S), 10, "0").alias(" ID "),
        F.col("full_name").alias("Full_Name "),
        F.col("abbreviation").alias("ABBREVIATION"),
        F.col("full_name").alias("Nickname"),
        F.col("city").alias("City"), F.col("state").alias("STATE"),
        F.coalesce(F.col("year_founded").cast(_S), F.lit("")).alias("Year_Founded"))


def raw_players(players: DataFrame) -> DataFrame:
    return players.select(
        F.col("player_id").cast(_S).alias("ID"), F.col("full_name").alias("FULL_NAME"),
        F.col("first_name").alias("First_Name"), F.col("last_name").alias("Last_Name"),
        F.when(F.col("is_active"), F.lit("True")).when(~F.col("is_active"), F.lit("False"))
         .alias("IS_ACTIVE"))


_STATS = ("pts", "fg_pct", "fg3_pct", "ft_pct", "reb", "ast", "tov")


def raw_games_matchup(games: DataFrame, teams: DataFrame, junk: bool = True,
                      season: str = "full") -> DataFrame:
    """Box-score export with a MATCHUP text instead of an opponent id."""
    g = with_style(_abbr(_abbr(games, teams, "team_id", "_t_abbr"), teams, "opponent_team_id", "_o_abbr"))
    season_c = {"full": F.col("season").cast(_S), "empty": F.lit(""),
                "none": None}[season]
    cols = [padded("game_id").alias("GAME_ID"), date_text().alias("GAME_DATE_EST"),
            F.col("team_id").cast(_S).alias("TEAM_ID"), matchup_text().alias("MATCHUP"),
            wl_text().alias("WL")]
    if season_c is not None:
        cols.append(season_c.alias("SEASON"))
    cols += [num_text(s).alias(s.upper()) for s in _STATS]
    clean = g.select(*cols)
    if not junk:
        return clean
    k = style(3)
    bad = g.select(*[
        F.when(k == 0, F.lit("not a date")).otherwise(date_text()).alias("GAME_DATE_EST") if c == "GAME_DATE_EST"
        else F.when(k == 1, F.concat(F.col("_t_abbr"), F.lit(" - "), F.col("_o_abbr")))
              .when(k == 2, F.concat(F.col("_t_abbr"), F.lit(" vs. X"), F.col("_o_abbr")))
              .otherwise(matchup_text()).alias("MATCHUP") if c == "MATCHUP"
        else clean_expr for c, clean_expr in zip(clean.columns, cols)])
    return clean.unionByName(bad)


def raw_games_oppid(games: DataFrame, junk: bool = True, with_home: bool = True,
                    with_stats: bool = True, missing_keys: bool = False) -> DataFrame:
    """Export with explicit opponent ids (and optionally a home flag)."""
    games = with_style(games)
    k = style(2)
    home = F.when(k == 0, F.when(F.col("is_home"), "1").otherwise("0")).otherwise(
        F.when(F.col("is_home"), "true").otherwise("false"))
    cols = [F.col("game_id").alias("game_id"), F.date_format("game_date", "yyyy-MM-dd").alias("date"),
            F.col("team_id").cast(_S).alias("team_id"),
            F.col("opponent_team_id").cast(_S).alias("opp_team_id"),
            F.col("wl").alias("w_l"), F.col("season").cast(_S).alias("season_id")]
    if with_home:
        cols.append(home.alias("home"))
    if with_stats:
        cols += [num_text(s).alias(s) for s in _STATS]
    clean = games.select(*cols)
    if not junk:
        return clean
    names = clean.columns
    k4 = style(4)
    if missing_keys:
        broken = {"game_id": F.when(k4 == 0, F.lit("")), "date": F.when(k4 == 1, F.lit("")),
                  "opp_team_id": F.when(k4 == 2, F.lit("")), "season_id": F.when(k4 == 3, F.lit(""))}
    else:
        broken = {"date": F.when(k4 < 2, F.lit("31/31/2001")), "opp_team_id": F.when(k4 >= 2, F.lit("n/a"))}
    bad = games.select(*[F.coalesce(broken[n], e).alias(n) if n in broken else e.alias(n)
                         for n, e in zip(names, cols)])
    if missing_keys:
        # the broken field is blank (not null) in the row: blanks read as missing
        bad = games.select(*[F.when(broken[n].isNotNull(), F.lit("")).otherwise(e).alias(n)
                             if n in broken else e.alias(n) for n, e in zip(names, cols)])
    return clean.unionByName(bad)


def raw_player_games(pg: DataFrame, teams: DataFrame, junk: bool = True) -> DataFrame:
    """Player box scores: MATCHUP text, MIN as 'M:SS' or a number, partly missing seasons."""
    g = with_style(_abbr(_abbr(pg, teams, "team_id", "_t_abbr"), teams, "opponent_team_id", "_o_abbr"))
    k = style(4)
    whole = F.floor(F.col("minutes"))
    secs = F.round((F.col("minutes") - whole) * 60).cast("int")
    min_text = F.when(k < 2, F.concat(whole.cast("bigint").cast(_S), F.lit(":"),
                                      F.lpad(secs.cast(_S), 2, "0"))).otherwise(F.col("minutes").cast(_S))
    cols = [F.col("player_id").cast(_S).alias("Player_ID"), padded("game_id").alias("Game_ID"),
            F.when(k == 3, F.lit("")).otherwise(F.col("season").cast(_S)).alias("SEASON_ID"),
            date_text().alias("GAME_DATE"), matchup_text().alias("MATCHUP"), wl_text().alias("WL"),
            min_text.alias("MIN")]
    cols += [num_text(s).alias(s.upper()) for s in
             ("pts", "reb", "ast", "tov", "plus_minus", "fg_pct", "fg3_pct", "ft_pct", "stl", "blk", "pf")]
    clean = g.select(*cols)
    if not junk:
        return clean
    names = clean.columns
    bad_date = F.when(k == 0, F.lit("13/45/2000")).otherwise(date_text())
    bad_match = (F.when(k == 1, F.concat(F.lit("Z"), F.col("_t_abbr"), F.lit(" @ "), F.col("_o_abbr")))
                  .when(k == 2, F.col("_t_abbr"))
                  .when(k == 3, F.concat(F.col("_t_abbr"), F.lit(" vs. Q"), F.col("_o_abbr")))
                  .otherwise(matchup_text()))
    bad = g.select(*[bad_date.alias(n) if n == "GAME_DATE" else bad_match.alias(n) if n == "MATCHUP"
                     else e.alias(n) for n, e in zip(names, cols)])
    return clean.unionByName(bad)
