"""Data profiling of the training dataset: coverage, target, missingness,
correlations, histograms, the heuristic baseline and the leakage check."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formmart.operators.form import rank_rows

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns (booleans, strings and dates excluded), in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def _long_form(row_df: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    """Turn the single wide row of per-column aggregates into (key, value) rows."""
    return row_df.unpivot([], [F.col(f"`{c}`") for c in names], key, value)


def coverage(ds: DataFrame) -> DataFrame:
    """Rows, dates and exact numbers of teams and games.

    Each distinct count dedupes its own column in two phases (before and after
    its exchange), so no row is expanded for another column's count.
    """
    parts = [ds.agg(F.count(F.lit(1)).alias("rows"), F.min("game_date").alias("start_date"), F.max("game_date").alias("end_date")),
             ds.select("team_id").distinct().agg(F.count("team_id").alias("num_teams")),
             ds.select("game_id").distinct().agg(F.count("game_id").alias("num_games"))]
    one = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)  # a row a part
    return one.agg(*[F.max(c).alias(c) for c in ("rows", "start_date", "end_date", "num_teams", "num_games")])


#: log2 of a sketch's registers: a relative standard error of 1.04 / sqrt(2^14), below 0.82%.
SKETCH_LOG_K = 14
SKETCH_ERROR = 1.04 / (1 << SKETCH_LOG_K) ** 0.5


def coverage_sketches(ds: DataFrame, day: str = "game_date") -> DataFrame:
    """Rows and sketches of the teams and games of each day, to be stored and merged for any range of days.

    A sketch has a fixed size (at most 2^``SKETCH_LOG_K`` registers), so the table
    grows with the days alone, and a range never reads the rows again.
    """
    sketch = lambda c: F.hll_sketch_agg(c, F.lit(SKETCH_LOG_K))
    return ds.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("rows"), sketch("team_id").alias("teams"),
                                                   sketch("game_id").alias("games"))


def coverage_estimate(sketches: DataFrame, *by: Column) -> DataFrame:
    """Rows, dates and estimated numbers of teams and games of the sketched days, all together or by groups of days."""
    merged = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c, F.lit(True)))
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.min("day").alias("start_date"), F.max("day").alias("end_date"),
                                     merged("teams").alias("num_teams"), merged("games").alias("num_games"))


def target_distribution(ds: DataFrame, target: str = "y_win") -> DataFrame:
    counts = ds.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    # one row per class: the global window runs over a two-row table
    return counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy()))


def missing_share(ds: DataFrame, top: int = 25) -> DataFrame:
    """Percent of nulls per column, highest first (ties by name), top ``top``."""
    wide = ds.agg(*[(F.avg(F.when(F.col(c).isNull(), 1).otherwise(0)) * 100.0).alias(c) for c in ds.columns])
    return (_long_form(wide, ds.columns, "column_name", "missing_pct")
            .orderBy(F.col("missing_pct").desc(), "column_name").limit(top))


def baseline_accuracy(ds: DataFrame) -> DataFrame:
    """Accuracy of 'win iff recent win rate beats the opponent's'."""
    pred = (F.col("winrate_l5") > F.col("opp_winrate_l5")).cast("int")
    return ds.agg(F.avg(F.when(pred == F.col("y_win"), 1).otherwise(0)).alias("baseline_accuracy"))


#: Columns whose co-moments one aggregate holds: 10 buffers each, below the 100 fields up to which Spark compiles a stage.
CORR_BATCH = 9


def correlations(ds: DataFrame, target: str = "y_win", top: int = 20) -> DataFrame:
    """Pearson correlation of every numeric column with ``target`` over pairwise
    non-null rows; a constant or all-null column gives null (sorted last).

    Rows stay wide: an aggregate holds count, means and central co-moments of a
    batch of columns, merges them pairwise (so large means don't cancel) and
    reads no other column.  A batch ends as one row, which is then unpivoted.
    """
    cols = numeric_columns(ds)
    y = F.col(f"`{target}`").cast("double")
    batches = []
    for at in range(0, len(cols), CORR_BATCH):
        batch, moments = cols[at:at + CORR_BATCH], []
        for i, c in enumerate(batch):
            x = F.col(f"`{c}`").cast("double")
            both = x.isNotNull() & y.isNotNull()
            moments += [F.covar_pop(x, y).alias(f"c{i}"), F.stddev_pop(F.when(both, x)).alias(f"x{i}"),
                        F.stddev_pop(F.when(both, y)).alias(f"y{i}")]
        den = [F.col(f"x{i}") * F.col(f"y{i}") for i in range(len(batch))]
        row = ds.agg(*moments).select(*[(F.col(f"c{i}") / F.when(d != 0, d)).alias(c) for i, (c, d) in enumerate(zip(batch, den))])
        batches.append(_long_form(row, batch, "column_name", "corr_with_y_win"))
    out = reduce(DataFrame.unionByName, batches) if batches else ds.sparkSession.createDataFrame(
        [], "column_name string, corr_with_y_win double")
    return out.orderBy(F.col("corr_with_y_win").desc_nulls_last(), "column_name").limit(top)


def histogram(ds: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over the non-null values; the last bin is closed.

    Bin of x = least(floor((x - lo) / (hi - lo) * bins), bins - 1).  A constant
    column spans [v - 0.5, v + 0.5].  All ``bins`` bins are returned.
    """
    vals = ds.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    mm = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if mm["lo"] is None:
        return ds.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, count bigint")
    lo, hi = mm["lo"], mm["hi"]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    b = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))), F.lit(bins - 1))
    counts = vals.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    frame = ds.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = F.lit(hi - lo)
    return (frame.join(counts, "bin", "left")
                 .select("bin",
                         (F.lit(lo) + F.col("bin").cast("double") * width / F.lit(float(bins))).alias("bin_start"),
                         (F.lit(lo) + (F.col("bin") + 1).cast("double") * width / F.lit(float(bins)))
                         .alias("bin_end"),
                         F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def leakage_violations(form: DataFrame, metrics: Sequence[tuple[str, str]], n: int = 5,
                       entity: str = "team_id", date_col: str = "game_date",
                       tie_cols: Sequence[str] = ("game_id",), tol: float = 1e-9) -> DataFrame:
    """Recompute each rolling mean from raw values of ranks r-n..r-1 by an equi-join
    and count rows whose window value differs (0 means no leakage).

    Every row is sent to its next ``n`` ranks, so the join is n-to-1 and never
    pairs a whole entity with itself.
    """
    ranked = rank_rows(form, entity, date_col, tie_cols, "_r")
    src = [s for s, _ in metrics]
    ahead = ranked.select(entity, F.explode(F.sequence(F.col("_r") + 1, F.col("_r") + n)).alias("_target"),
                          *[F.col(s).alias("_v_" + s) for s in src])
    recomputed = ahead.groupBy(entity, "_target").agg(*[F.avg("_v_" + s).alias("_m_" + s) for s in src])
    joined = ranked.join(recomputed, (ranked[entity] == recomputed[entity]) & (ranked._r == recomputed._target),
                         "left").drop(recomputed[entity])
    rows = []
    for s, out in metrics:
        a, b = F.col(out), F.col("_m_" + s)
        bad = ~((a.isNull() & b.isNull()) | (F.abs(a - b) <= F.lit(tol)))
        rows.append(F.sum(F.when(bad, 1).otherwise(0)).alias(out))
    wide = joined.agg(F.count(F.lit(1)).alias("_rows"), *rows)
    return (wide.unpivot(["_rows"], [o for _, o in metrics], "feature", "violations")
                .select("feature", F.col("_rows").alias("rows_checked"), "violations"))
