"""Schemas, column-name candidates and metric lists of the standard tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source project's for the same input to
# standardize the same way and for outputs to carry the same names.
# ---------------------------------------------------------------------------

# Candidate raw column names, first match wins (matching is case-insensitive).
TEAM_ID = ("id", "team_id")
TEAM_NAME = ("full_name", "team_name", "nickname")
TEAM_ABBR = ("abbreviation", "abbr")
TEAM_CITY = ("city",)
TEAM_STATE = ("state",)
TEAM_FOUNDED = ("year_founded", "founded")

PLAYER_ID = ("id", "player_id")
PLAYER_FULL_NAME = ("full_name",)
PLAYER_FIRST_NAME = ("first_name",)
PLAYER_LAST_NAME = ("last_name",)
PLAYER_ACTIVE = ("is_active",)

GAME_TEAM_ID = ("team_id",)
GAME_WL = ("wl", "w_l")
GAME_MATCHUP = ("matchup",)
GAME_OPP_ID = ("opponent_team_id", "opp_team_id")
GAME_ID = ("game_id", "id")
GAME_SEASON = ("season", "season_id", "year")
GAME_DATE = ("game_date_real", "game_date_est", "game_date", "date")
GAME_HOME = ("is_home", "home")
GAME_STATS = ("pts", "fg_pct", "fg3_pct", "ft_pct", "reb", "ast", "tov")

PG_PLAYER_ID = ("player_id", "playerid")
PG_GAME_ID = ("game_id", "id")
PG_SEASON = ("season_id", "season")          # note: other priority than games
PG_DATE = ("game_date_real", "game_date", "game_date_est")  # and here too
PG_MATCHUP = ("matchup",)
PG_WL = ("wl", "w_l")
PG_MINUTES = ("min", "minutes")
PG_STATS = ("pts", "reb", "ast", "tov", "plus_minus", "fg_pct", "fg3_pct", "ft_pct", "stl", "blk", "pf")

# Columns that must be present after standardization or the row is dropped.
GAMES_REQUIRED = ("game_id", "game_date", "team_id", "opponent_team_id", "season")
PLAYER_GAMES_REQUIRED = ("player_id", "game_id", "game_date", "team_id", "opponent_team_id")

# Rolling team form: metric → output column (window: previous N rows, N=5).
TEAM_FORM_METRICS = (
    ("pts", "pts_avg_l5"),
    ("reb", "reb_avg_l5"),
    ("ast", "ast_avg_l5"),
    ("tov", "tov_avg_l5"),
    ("fg_pct", "fg_pct_avg_l5"),
    ("fg3_pct", "fg3_pct_avg_l5"),
    ("ft_pct", "ft_pct_avg_l5"),
)
# Rolling player form.
PLAYER_FORM_METRICS = (
    ("minutes", "min_avg_l5"),
    ("pts", "pts_avg_l5"),
    ("plus_minus", "pm_avg_l5"),
)

# Team-side features of the training dataset, in output order.
TEAM_FEATURES = (
    "rest_days", "pts_avg_l5", "reb_avg_l5", "ast_avg_l5", "tov_avg_l5",
    "fg_pct_avg_l5", "fg3_pct_avg_l5", "ft_pct_avg_l5", "winrate_l5",
)
STAR_FEATURES = ("star_pts_avg_l5_sum", "star_min_avg_l5_avg", "star_pm_avg_l5_avg")
DATASET_KEYS = ("game_id", "season", "game_date", "team_id", "opponent_team_id", "is_home", "y_win")
# Identifier/label columns never used as model inputs.
NON_FEATURES = ("game_id", "season", "game_date", "team_id", "opponent_team_id", "y_win")
# Columns hidden from the matchup comparison table; default indicators first.
COMPARE_IGNORE = ("game_id", "season", "game_date", "team_id", "opponent_team_id", "y_win", "is_home")
COMPARE_DEFAULTS = (
    "winrate_l5", "pts_avg_l5", "fg_pct_avg_l5", "fg3_pct_avg_l5",
    "tov_avg_l5", "reb_avg_l5", "ast_avg_l5", "rest_days",
)

# Feature glossary (indicator → plain-language explanation).
GLOSSARY = {
    "pts_avg_l5": "Average points scored in the last 5 games (more is better).",
    "reb_avg_l5": "Average rebounds in the last 5 games (recovering the ball after missed shots).",
    "ast_avg_l5": "Average assists in the last 5 games (passes leading to a score).",
    "tov_avg_l5": "Average turnovers in the last 5 games (lower is better; turnovers are lost possessions).",
    "fg_pct_avg_l5": "Average field-goal percentage (overall shooting accuracy) in the last 5 games.",
    "fg3_pct_avg_l5": "Average 3-point percentage in the last 5 games.",
    "ft_pct_avg_l5": "Average free-throw percentage in the last 5 games.",
    "winrate_l5": "Win rate in the last 5 games (0 to 1).",
    "rest_days": "Days since the previous game (more rest can help).",
    "opp_pts_avg_l5": "Opponent average points scored in the last 5 games.",
    "opp_reb_avg_l5": "Opponent average rebounds in the last 5 games.",
    "opp_ast_avg_l5": "Opponent average assists in the last 5 games.",
    "opp_tov_avg_l5": "Opponent average turnovers in the last 5 games.",
    "opp_fg_pct_avg_l5": "Opponent average field-goal percentage in the last 5 games.",
    "opp_fg3_pct_avg_l5": "Opponent average 3-point percentage in the last 5 games.",
    "opp_ft_pct_avg_l5": "Opponent average free-throw percentage in the last 5 games.",
    "opp_winrate_l5": "Opponent win rate in the last 5 games.",
    "opp_rest_days": "Opponent days since previous game.",
    "star_pts_avg_l5_sum": "Sum of last-5 scoring averages for the team’s top 3 in-form players.",
    "star_min_avg_l5_avg": "Average minutes (last 5 games) for the team’s top 3 in-form players.",
    "star_pm_avg_l5_avg": "Average plus/minus (last 5 games) for the team’s top 3 in-form players.",
    "opp_star_pts_avg_l5_sum": "Same as star_pts_avg_l5_sum but for the opponent.",
    "opp_star_min_avg_l5_avg": "Same as star_min_avg_l5_avg but for the opponent.",
    "opp_star_pm_avg_l5_avg": "Same as star_pm_avg_l5_avg but for the opponent.",
}

# Date formats accepted by the tolerant date parser, tried in order, each only
# on text of its shape (so a failed attempt never costs a parse error).
DATE_FORMATS = (
    ("yyyy-MM-dd", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("yyyy-MM-dd HH:mm:ss", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$"),
    ("yyyy-MM-dd'T'HH:mm:ss", r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{2}:\d{2}$"),
    ("yyyy-MM-dd HH:mm", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}$"),
    ("MMMM d, yyyy", r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$"),
    ("d MMM yyyy", r"^\d{1,2} [A-Za-z]{3} \d{4}$"),
    ("MMM dd, yyyy", r"^[A-Za-z]{3} \d{2}, \d{4}$"),
    ("MMM d, yyyy", r"^[A-Za-z]{3} \d{1,2}, \d{4}$"),
    ("MM/dd/yyyy", r"^\d{2}/\d{2}/\d{4}$"),
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("yyyy/MM/dd", r"^\d{4}/\d{1,2}/\d{1,2}$"),
    ("yyyyMMdd", r"^\d{8}$"),
)

# ---------------------------------------------------------------------------
# Standard (clean) table schemas.
# ---------------------------------------------------------------------------

TEAMS = T.StructType([
    T.StructField("team_id", T.LongType(), False),
    T.StructField("full_name", T.StringType()),
    T.StructField("abbreviation", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("year_founded", T.IntegerType()),
])

PLAYERS = T.StructType([
    T.StructField("player_id", T.LongType(), False),
    T.StructField("full_name", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
])

GAMES_COLUMNS = ("game_id", "season", "game_date", "team_id", "opponent_team_id", "is_home", "wl",
                 "pts", "fg_pct", "fg3_pct", "ft_pct", "reb", "ast", "tov")
PLAYER_GAMES_COLUMNS = ("player_id", "game_id", "season", "game_date", "team_id", "opponent_team_id",
                        "is_home", "wl", "minutes", "pts", "reb", "ast", "tov", "plus_minus",
                        "fg_pct", "fg3_pct", "ft_pct", "stl", "blk", "pf")
