"""formmart — a Spark-native recent-form feature mart.

Competition logs (teams, games, players, player-games) are standardized into
typed tables, turned into leakage-safe rolling features (previous N events,
never the current one) with DataFrame windows, joined with opponent and
top-player features, and served as analytics, profiling, splits, metrics and
MLlib models — all as set-oriented Spark jobs.
"""

from formmart.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
