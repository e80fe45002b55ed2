"""Side-by-side indicator comparison for every game of the dataset.

The dataset row of a team already carries the opponent's features
(``opp_<name>``), so pairing the two sides of a game needs no further join:
each chosen indicator is unpivoted into (team value, opponent value, A − B).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formmart import schemas as S
from formmart.functions.labels import quantize
from formmart.operators.joins import small_side


def glossary_frame(spark: SparkSession, glossary: dict[str, str] | None = None) -> DataFrame:
    g = S.GLOSSARY if glossary is None else glossary
    return spark.createDataFrame(sorted(g.items()), "indicator string, explanation string")


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """Glossary JSON object (indicator → text) as rows; a missing file gives no rows."""
    from formmart.sources.csv import _exists
    if not _exists(spark, path):
        return spark.createDataFrame([], "indicator string, explanation string")
    obj = spark.read.option("multiLine", True).json(path)
    return obj.unpivot([], obj.columns, "indicator", "explanation")


def _shown(columns: Sequence[str]) -> list[tuple[int, str]]:
    """(place, name) of the own-side indicators: the preferred ones by their order, the rest behind."""
    preferred = {name: i for i, name in enumerate([*S.COMPARE_DEFAULTS, *S.STAR_FEATURES])}
    own = [c for c in columns if not c.startswith("opp_") and c not in S.COMPARE_IGNORE]
    return sorted(((preferred.get(c, len(preferred)), c) for c in own), key=lambda x: x[0])


def indicator_list(columns: Sequence[str]) -> list[str]:
    """All indicators of a dataset, in the order in which they are offered."""
    return [name for _, name in _shown(columns)]


def default_indicators(columns: Sequence[str]) -> list[str]:
    """The preferred indicators that a dataset has."""
    known = len(S.COMPARE_DEFAULTS) + len(S.STAR_FEATURES)
    return [name for place, name in _shown(columns) if place < known]


def _by_gap(left: Column, right: Column) -> Column:
    """Comparator: larger |difference| first (quantized to 9 decimals), nulls last, then indicator order."""
    lk, rk = F.abs(quantize(left["difference"], 9)), F.abs(quantize(right["difference"], 9))
    by_ordinal = F.signum(left["ordinal"] - right["ordinal"]).cast("int")
    return (F.when(lk.isNull() & rk.isNull(), by_ordinal)
             .when(lk.isNull(), F.lit(1)).when(rk.isNull(), F.lit(-1))
             .when(lk > rk, F.lit(-1)).when(lk < rk, F.lit(1))
             .otherwise(by_ordinal))


def matchup_compare(dataset: DataFrame, glossary: DataFrame,
                    indicators: Sequence[str] | None = None) -> DataFrame:
    """(game, team, indicator, explanation, team/opponent value, difference, position).

    ``position`` orders a game's indicators by |difference| descending (nulls
    last, then indicator order), as the comparison table is shown.  All of a
    table's rows come from one dataset row, so they are ordered inside that row
    (array sort, then positional explode): no shuffle.
    """
    ind = list(indicators or default_indicators(dataset.columns))
    pairs = F.array(*[F.struct(F.lit(c).alias("indicator"), F.lit(i).alias("ordinal"),
                               F.col(c).cast("double").alias("team_value"),
                               F.col("opp_" + c).cast("double").alias("opponent_value"),
                               (F.col(c).cast("double") - F.col("opp_" + c).cast("double")).alias("difference"))
                      for i, c in enumerate(ind)])
    long = dataset.select("game_id", "team_id", "opponent_team_id",
                          F.posexplode(F.array_sort(pairs, _by_gap)).alias("pos", "x")).select(
        "game_id", "team_id", "opponent_team_id", "x.*", (F.col("pos") + 1).cast("int").alias("position"))
    long = long.join(small_side(glossary), "indicator", "left").withColumn(
        "explanation", F.coalesce(F.col("explanation"), F.lit("")))
    return long.select("game_id", "team_id", "opponent_team_id", "indicator", "explanation", "team_value",
                       "opponent_value", "difference", "position")
