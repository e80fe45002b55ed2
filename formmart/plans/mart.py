"""The feature mart: standard tables → views, with explicit materialization points.

Two sub-plans are used twice downstream and would otherwise be planned twice
(the optimizer prunes and filters each use differently, so no exchange is
reused): the team form table (both sides of the opponent join), the player
form table (star ranking and the player views) and the team star table (own
and opponent enrichment).  The training datasets (base and enriched) feed
every profiling, split, metric, comparison and model step.  All five are
written once as parquet under the shared working folder, which
also cuts their lineage so a lost executor only re-reads files.  The tables that
are joined by game (team form, star features, base dataset) are bucketed and
sorted by game, so neither the opponent join nor the star join has an exchange.
"""

from __future__ import annotations

import re
import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formmart.operators import features as V
from formmart.operators.form import DEFAULT_CHUNK_ROWS
from formmart.session import compact_tables, scratch_path, settings
from formmart.sources.tables import VersionedTable, bucketed_table


@dataclass(frozen=True)
class StandardTables:
    """Typed base tables; the player tables are optional (both or neither)."""
    teams: DataFrame
    games: DataFrame
    players: DataFrame | None = None
    player_games: DataFrame | None = None
    rejected: dict = field(default_factory=dict, compare=False)   # table → reason → dropped rows

    @property
    def has_players(self) -> bool:
        return self.players is not None and self.player_games is not None


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` at once (see :class:`formmart.sources.tables.VersionedTable`) and return a scan of it."""
    return VersionedTable(df.sparkSession, path).replace(df)


def materialize(df: DataFrame, name: str) -> DataFrame:
    with compact_tables(df.sparkSession):
        return write_table(df, scratch_path(df.sparkSession, "tables", name))


def colocated(df: DataFrame, name: str, key: str = "game_id") -> DataFrame:
    """The frame written once, bucketed and sorted by ``key``; joins and groups on the key then need no exchange.

    The table's files lie below the shared folder, its entry (buckets, order) in
    the session's catalog.  There are as many buckets as shuffle partitions.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bucketed_table(df.repartition(buckets, key), name, key, buckets)


def _catalog_tables(value) -> list[str]:
    """Names of the tables of :func:`colocated` that a frame reads directly."""
    if not isinstance(value, DataFrame):
        return []
    return sorted(set(re.findall(r"\bfm_\w+_[0-9a-f]{12}\b", value._jdf.queryExecution().analyzed().toString())))


class Mart:
    """Views of one set of standard tables.

    ``n`` is the look-back of every rolling feature; ``chunk_rows`` bounds how
    many events of one entity a single window task sees.
    """

    VIEW_NAMES = ("v_games", "v_teams", "v_team_form", "v_training_dataset", "v_training_dataset_named",
                  "v_player_games", "v_players", "v_player_form", "v_team_star_features",
                  "v_training_dataset_enriched", "v_training_dataset_enriched_named")

    def __init__(self, spark: SparkSession, tables: StandardTables, n: int = 5,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS, materialize_intermediates: bool = True):
        self.spark = spark
        self.tables = tables
        self.n = n
        self.chunk_rows = chunk_rows
        self._mat = materialize_intermediates
        self._cache: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def _memo(self, key: str, build, persist=None) -> DataFrame:
        """Build once; ``persist`` writes the frame (:func:`materialize` or :func:`colocated`)."""
        with self._lock:
            if key not in self._cache:
                # tables bucketed by game are joined on (game, team) as they lie, also in a session that doesn't say so
                with settings(self.spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
                    df = build()
                    self._cache[key] = persist(df, key) if (persist and self._mat) else df
            return self._cache[key]

    def close(self) -> None:
        """Forget all built frames and drop the catalog's entries of the written tables."""
        with self._lock:
            for df in self._cache.values():
                for name in _catalog_tables(df):
                    self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._cache.clear()

    def adopt(self, other: Mart, keys) -> None:
        """Reuse another mart's materialized tables built from the same games."""
        if other.tables.games is not self.tables.games or other.n != self.n:
            raise ValueError("can only share tables built from the same games and look-back")
        for k in keys:
            self._cache[k] = getattr(other, k)()

    def memo(self, key: str, build) -> DataFrame:
        """Build once per mart (e.g. plans whose construction runs small jobs)."""
        return self._memo(key, build)

    # -- base views ---------------------------------------------------------
    def v_games(self) -> DataFrame:
        return V.v_games(self.tables.games)

    def v_teams(self) -> DataFrame:
        return V.v_teams(self.tables.teams)

    def v_player_games(self) -> DataFrame:
        self._need_players()
        return V.v_player_games(self.tables.player_games)

    def v_players(self) -> DataFrame:
        self._need_players()
        return V.v_players(self.tables.players)

    # -- features -----------------------------------------------------------
    def team_form(self) -> DataFrame:
        return self._memo("team_form", lambda: V.team_form(self.tables.games, self.n,
                                                           chunk_rows=self.chunk_rows), persist=colocated)

    def training_dataset(self) -> DataFrame:
        return self._memo("training_dataset", lambda: V.opponent_join(self.team_form()), persist=colocated)

    def player_form(self) -> DataFrame:
        self._need_players()
        return self._memo("player_form", lambda: V.player_form(self.tables.player_games, self.n,
                                                               chunk_rows=self.chunk_rows), persist=materialize)

    def team_star_features(self) -> DataFrame:
        self._need_players()
        return self._memo("team_star", lambda: V.team_star_features(self.player_form()), persist=colocated)

    def training_dataset_enriched(self) -> DataFrame:
        def enriched():
            stars = self.team_star_features()  # the larger tables' shuffles come before the base dataset takes its place on disk
            return V.enrich(self.training_dataset(), stars)

        return self._memo("training_dataset_enriched", enriched, persist=materialize)

    def training_dataset_named(self) -> DataFrame:
        return V.with_names(self.training_dataset(), self.tables.teams)

    def training_dataset_enriched_named(self) -> DataFrame:
        return V.with_names(self.training_dataset_enriched(), self.tables.teams, enriched=True)

    # -- dataset choice -------------------------------------------------------
    @property
    def dataset_view(self) -> str:
        return "v_training_dataset_enriched" if self.tables.has_players else "v_training_dataset"

    def dataset(self) -> DataFrame:
        """Enriched dataset when player tables exist, else the base one."""
        return self.training_dataset_enriched() if self.tables.has_players else self.training_dataset()

    def named_dataset(self) -> DataFrame:
        return (self.training_dataset_enriched_named() if self.tables.has_players
                else self.training_dataset_named())

    def _need_players(self):
        if not self.tables.has_players:
            raise ValueError("player tables are not available in this mart")

    # -- catalog ------------------------------------------------------------
    def _view_builders(self) -> dict:
        views = {"v_games": self.v_games, "v_teams": self.v_teams, "v_team_form": self.team_form,
                 "v_training_dataset": self.training_dataset,
                 "v_training_dataset_named": self.training_dataset_named}
        if self.tables.has_players:
            views.update({"v_player_games": self.v_player_games, "v_players": self.v_players,
                          "v_player_form": self.player_form,
                          "v_team_star_features": self.team_star_features,
                          "v_training_dataset_enriched": self.training_dataset_enriched,
                          "v_training_dataset_enriched_named": self.training_dataset_enriched_named})
        return views

    def register_missing_views(self) -> list[str]:
        """Create only the views not yet in the catalog (existing ones are kept); returns those created."""
        created = []
        for name, fn in self._view_builders().items():
            if not self.spark.catalog.tableExists(name):
                fn().createOrReplaceTempView(name)
                created.append(name)
        return created

    def register_views(self) -> list[str]:
        """Create-or-replace every view this mart can serve; drop stale player views."""
        views = self._view_builders()
        for name in self.VIEW_NAMES:
            if name not in views:
                self.spark.catalog.dropTempView(name)
        for name, fn in views.items():
            fn().createOrReplaceTempView(name)
        return sorted(views)
