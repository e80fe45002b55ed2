"""Classification metrics and calibration as distributed aggregations.

All take a DataFrame with a 0/1 label column and a probability column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formmart.functions.labels import percent_text
from formmart.operators.quantiles import exact_quantiles

EPS = 2.220446049250313e-16  # double machine epsilon: probabilities are clipped to [eps, 1 - eps]


def accuracy(df: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5) -> DataFrame:
    """Share of rows where (p >= threshold) equals the label."""
    pred = (F.col(p) >= threshold).cast("int")
    return df.agg(F.avg(F.when(pred == F.col(y), 1).otherwise(0)).alias("accuracy"))


def log_loss(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    q = F.least(F.greatest(F.col(p), F.lit(EPS)), F.lit(1 - EPS))
    yy = F.col(y).cast("double")
    return df.agg((-F.avg(yy * F.log(q) + (1 - yy) * F.log(1 - q))).alias("log_loss"))


def accuracy_and_log_loss(df: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5) -> DataFrame:
    """Both point metrics in one pass over the scored rows."""
    pred = (F.col(p) >= threshold).cast("int")
    q = F.least(F.greatest(F.col(p), F.lit(EPS)), F.lit(1 - EPS))
    yy = F.col(y).cast("double")
    return df.agg(F.avg(F.when(pred == F.col(y), 1).otherwise(0)).alias("accuracy"),
                  (-F.avg(yy * F.log(q) + (1 - yy) * F.log(1 - q))).alias("log_loss"))


def roc_auc(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Area under the ROC curve with ties counted as one half; null for a single class.

    Equals the rank-sum statistic with average ranks.  Scores are reduced to
    distinct values with (positives, negatives) counts, which are range-sorted
    once.  Each range gives one row: its positives, its negatives and its own
    pairs, from a running count of negatives; the pairs with the ranges before
    it need their totals alone, a table of one row a range.  No task orders all
    scores.  Null scores come first, NaN last.
    """
    scores = df.select(F.col(p).cast("double").alias("s"), F.col(y).cast("int").alias("y"))
    dist = scores.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    ranges = (dist.repartitionByRange("s").sortWithinPartitions("s").select("pos", "neg")
              .mapInArrow(_pairs_inside, "part int, pos double, neg double, pairs double"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    pairs = F.col("pairs") + F.col("pos") * F.coalesce(F.sum("neg").over(before), F.lit(0.0))
    total = (ranges.select("pos", "neg", pairs.alias("c"))
             .agg(F.sum("c").alias("c"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    return total.select(F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("c") / (F.col("pos") * F.col("neg")))
                        .alias("roc_auc"))


def _pairs_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positives, negatives, and pairs of a negative before a positive (ties: half) in one sorted range."""
    pos = neg = pairs = 0.0
    for batch in batches:
        p, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("pos", "neg"))
        p, n = np.nan_to_num(p), np.nan_to_num(n)  # rows without a label count for neither class
        below = neg + np.cumsum(n) - n
        pairs += float((p * (below + n * 0.5)).sum())
        pos, neg = pos + float(p.sum()), neg + float(n.sum())
    yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                      "pos": [pos], "neg": [neg], "pairs": [pairs]})


def calibration(df: DataFrame, y: str = "y", p: str = "p", bins: int = 10) -> DataFrame:
    """Quantile-binned reliability curve: (bin, mean predicted, fraction positive, rows).

    Edges are the exact linear-interpolation quantiles of p at i/bins; a row's
    bin is the number of interior edges strictly below its p; empty bins are
    absent.
    """
    probs = [i / bins for i in range(1, bins)]
    q = exact_quantiles(df, [p], probs)[p]
    if q[0] is None:
        return df.sparkSession.createDataFrame([], "bin int, mean_predicted double, fraction_positive double, "
                                                   "rows bigint")
    b = sum((F.col(p) > F.lit(float(e))).cast("int") for e in q)
    return (df.groupBy(b.alias("bin"))
              .agg(F.avg(F.col(p)).alias("mean_predicted"), F.avg(F.col(y).cast("double")).alias("fraction_positive"),
                   F.count(F.lit(1)).alias("rows")))


def matchup_probability(scored: DataFrame, p: str = "p") -> DataFrame:
    """Both sides' raw probabilities of a game normalized to sum to one (raw if the sum is 0)."""
    a = scored.select("game_id", "team_id", "opponent_team_id", F.col(p).alias("p_team"))
    b = scored.select(F.col("game_id").alias("_g"), F.col("team_id").alias("_t"), F.col(p).alias("p_opponent"))
    j = a.join(b, (a.game_id == b._g) & (a.opponent_team_id == b._t))
    s = F.col("p_team") + F.col("p_opponent")
    out = j.select("game_id", "team_id", "opponent_team_id", "p_team", "p_opponent",
                   F.when(s > 0, F.col("p_team") / s).otherwise(F.col("p_team")).alias("p_norm"))
    return out.withColumn("p_norm_text", percent_text("p_norm"))
