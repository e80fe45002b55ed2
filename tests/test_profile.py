"""Wide co-moments and coverage sketches."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from formmart.operators import profile as PR


def test_correlations_of_columns_with_large_means(spark):
    """Means of 1e9 don't cancel; 23 columns make three batches."""
    rng = np.random.default_rng(2)
    n = 400
    y = rng.integers(0, 2, n)
    data = {f"c.{i}": 1e9 + rng.normal(0, 1, n) + y * i / 10 for i in range(21)} | {"flat": np.full(n, 5.0), "gone": np.zeros(n)}
    rows = [(int(y[i]) if i % 11 else None, *[None if c == "gone" or (i + k) % 13 == 0 else float(v[i]) for k, (c, v) in enumerate(data.items())])
            for i in range(n)]
    df = spark.createDataFrame(rows, "y_win int, " + ", ".join(f"`{c}` double" for c in data))
    got = {r.column_name: r.corr_with_y_win for r in PR.correlations(df, top=100).collect()}
    assert set(got) == {"y_win", *data} and got["gone"] is None
    for k, c in enumerate(data):
        pairs = [(r[0], r[k + 1]) for r in rows if r[0] is not None and r[k + 1] is not None]
        if c in ("flat", "gone"):
            assert got[c] is None
        else:
            assert got[c] == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1], abs=1e-6)
    plan = PR.correlations(df)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "explode" not in plan


def test_coverage_counts_without_expanding(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i % 40), None if i % 9 == 0 else i % 30, f"g{i // 2}") for i in range(500)]
    df = spark.createDataFrame(rows, "game_date date, team_id int, game_id string")
    assert tuple(PR.coverage(df).first()) == (500, dt.date(2020, 1, 1), dt.date(2020, 2, 9), 30, 250)
    assert "Expand" not in PR.coverage(df)._jdf.queryExecution().toString()
    assert tuple(PR.coverage(df.limit(0)).first()) == (0, None, None, 0, 0)


def test_sketches_merge_for_any_range_within_their_error(spark):
    """60,000 games over 50 days: each range of days is estimated from the stored sketches alone."""
    df = spark.range(120_000).select(F.date_add(F.lit(dt.date(2021, 1, 1)), (F.col("id") % 50).cast("int")).alias("game_date"),
                                     (F.col("id") % 977).alias("team_id"), (F.col("id") % 60_000).cast("string").alias("game_id"))
    sketches = PR.coverage_sketches(df).persist()
    try:
        for lo, hi in ((0, 49), (10, 30), (7, 7)):
            days = F.datediff("day", F.lit(dt.date(2021, 1, 1))).between(lo, hi)
            guess = PR.coverage_estimate(sketches.where(days)).first()
            inside = F.datediff("game_date", F.lit(dt.date(2021, 1, 1))).between(lo, hi)
            exact = PR.coverage(df.where(inside)).first()
            assert (guess.rows, guess.start_date, guess.end_date) == (exact.rows, exact.start_date, exact.end_date)
            assert abs(guess.num_teams - exact.num_teams) <= 5 * PR.SKETCH_ERROR * exact.num_teams
            assert abs(guess.num_games - exact.num_games) <= 5 * PR.SKETCH_ERROR * exact.num_games
    finally:
        sketches.unpersist()
