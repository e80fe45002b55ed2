"""Split sizes, metric edge cases, calibration and normalization invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from formmart.operators import metrics as M
from formmart.operators.quantiles import exact_medians, exact_quantiles
from formmart.operators.split import split_counts, time_split


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 15, 25])
def test_split_sizes_and_order(spark, n):
    rows = [(f"g{i:03d}", dt.date(2020, 1, 1) + dt.timedelta(days=i // 3), i % 2) for i in range(n)]
    df = spark.createDataFrame(rows, "game_id string, game_date date, team_id int")
    out = time_split(df, tie_cols=("game_id", "team_id")).collect()
    got = {s: sum(1 for r in out if r.split == s) for s in ("train", "val", "test")}
    tr, va, te = split_counts(n)
    assert (got["train"], got["val"], got["test"]) == (tr, va, te)
    assert tr + va + te == n
    key = {s: [(r.game_date, r.game_id, r.team_id) for r in out if r.split == s] for s in got}
    if key["train"] and key["val"]:
        assert max(key["train"]) < min(key["val"])
    if key["val"] and key["test"]:
        assert max(key["val"]) < min(key["test"])


@pytest.mark.parametrize("days", [1, 2, 4, 40])
def test_split_with_null_dates_and_crowded_days(spark, days):
    """Rows without a date are the oldest; exact counts however many rows share a cut's day."""
    for n, nulls in ((10, 3), (40, 0), (40, 39), (40, 40), (13, 12)):
        rows = [(f"g{(i * 7) % n:03d}", None if i < nulls else dt.date(2020, 1, 1) + dt.timedelta(days=i % days), None if i % 5 == 0 else i % 2)
                for i in range(n)]
        df = spark.createDataFrame(rows, "game_id string, game_date date, team_id int")
        out = time_split(df).collect()
        order = sorted(out, key=lambda r: (r.game_date is not None, r.game_date or dt.date.min, r.game_id, r.team_id is not None, r.team_id or 0))
        tr, va, te = split_counts(n)
        assert [r.split for r in order] == ["train"] * tr + ["val"] * va + ["test"] * te


def test_split_sorts_no_other_day(spark, monkeypatch):
    from formmart.operators import split as SP
    seen = []
    real = SP.keys_at_ranks
    monkeypatch.setattr(SP, "keys_at_ranks", lambda rows, *a: (seen.append(rows.count()), real(rows, *a))[1])
    rows = [(f"g{i:03d}", dt.date(2020, 1, 1) + dt.timedelta(days=i // 10), i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "game_id string, game_date date, team_id int")
    assert SP.time_split(df).groupBy("split").count().count() == 3 and seen == []       # cuts between days
    assert SP.time_split(df, test_size=0.25, val_size=0.1).count() == 100 and seen == [10, 10]  # two cut days
    plan = SP.time_split(df)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_half_even_counts():
    assert split_counts(25) == (18, 2, 5)   # round(2.5) = 2
    assert split_counts(15) == (10, 2, 3)   # round(1.5) = 2
    assert split_counts(2) == (2, 0, 0)     # no test rows rather than all rows


def test_auc_ties_and_single_class(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.8), (1, 0.6), (0, 0.2), (0, 0.6)], "y int, p double")
    # pairs (pos, neg): (0.8,0.8)=.5 (0.8,0.2)=1 (0.8,0.6)=1 (0.6,0.8)=0 (0.6,0.2)=1 (0.6,0.6)=.5 → 4/6
    assert M.roc_auc(df).first()[0] == pytest.approx(4 / 6)
    one = spark.createDataFrame([(1, 0.3), (1, 0.9)], "y int, p double")
    assert M.roc_auc(one).first()[0] is None


def test_logloss_clips_and_accuracy(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.5)], "y int, p double")
    ll = M.log_loss(df).first()[0]
    assert ll == pytest.approx(-(2 * (-2.220446049250313e-16) + (-0.6931471805599453)) / 3, rel=1e-9)
    assert M.accuracy(df).first()[0] == pytest.approx(1.0)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float(v) for v in np.random.default_rng(1).integers(0, 50, 501)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.1, 0.25, 0.5, 0.9]
    got = exact_quantiles(df, ["x"], probs, buckets=8)["x"]
    want = np.percentile([v for v in vals if v is not None], [p * 100 for p in probs])
    assert got == pytest.approx(list(want))
    assert exact_medians(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double"), ["x"])["x"] == 2.5


@pytest.mark.parametrize("limit", [1, 40])
def test_order_statistics_of_many_shapes(spark, monkeypatch, limit):
    """Ties, two values, infinities, signed zeros, NaN, nulls and a constant, at every tenth rank."""
    import numpy as np
    from formmart.operators import quantiles as Q
    monkeypatch.setattr(Q, "BRACKET_VALUES", limit)
    rng = np.random.default_rng(5)
    n = 700
    shapes = {"unique": rng.normal(0, 1e9, n), "ties": rng.integers(0, 7, n).astype(float), "two": np.where(rng.random(n) < .5, 2.0, 3.0),
              "same": np.full(n, 4.5), "signed": rng.choice([-0.0, 0.0, 1e-300, -1e-300], n),
              "ends": rng.choice([-np.inf, np.inf, 0.0, 1.0], n), "skew": np.exp(rng.normal(0, 9, n))}
    gone = rng.random(n)
    rows = [tuple(float(v[i]) if gone[i] > .1 else (None if gone[i] > .05 else float("nan")) for v in shapes.values()) for i in range(n)]
    df = spark.createDataFrame([(*r, None, 1) for r in rows], ", ".join(f"`{c}.x` double" for c in shapes) + ", none double, below int")
    ranks = {f"{c}.x": set(range(0, 500, 50)) | {1, 2, 51} for c in shapes}
    counts, got = Q.order_statistics(df, [f"{c}.x" for c in shapes] + ["none"], ranks | {"none": {0}})
    for k, c in enumerate(shapes):
        want = sorted(r[k] for r in rows if r[k] is not None and r[k] == r[k])
        assert counts[f"{c}.x"] == len(want)
        assert [got[f"{c}.x", r] for r in sorted(ranks[f"{c}.x"])] == [want[r] for r in sorted(ranks[f"{c}.x"])]
    assert "none" not in counts
    assert Q.exact_medians(df, ["none"]) == {"none": None}


def test_a_million_distinct_values_without_exploding(spark):
    import numpy as np
    from formmart.operators import quantiles as Q
    n = 1_000_003
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("x"), (F.col("id") % 10).alias("y"))
    got = Q.exact_quantiles(df, ["x", "y"], [0.1, 0.25, 0.5, 0.999])
    assert got["x"] == pytest.approx([(n - 1) * p for p in (0.1, 0.25, 0.5, 0.999)])
    assert got["y"] == list(np.percentile(np.arange(n) % 10, [10, 25, 50, 99.9]))


def test_no_exchange_of_values(spark):
    """The passes are single rows: nothing is generated or shuffled by value."""
    from formmart.operators import quantiles as Q
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    b = Q.Bracket("x", 50, True, 100)
    b.ask = (10.0, 50.0, 60.0)
    plan = df.agg(*[e.alias(f"a{i}") for i, e in enumerate([*Q._counted(b), Q._known(b)])])._jdf.queryExecution().toString()
    assert "Generate" not in plan and "hashpartitioning" not in plan and "Expand" not in plan


def test_calibration_bins(spark):
    rows = [(i % 2, i / 100) for i in range(100)]
    df = spark.createDataFrame(rows, "y int, p double")
    out = M.calibration(df).collect()
    assert len(out) == 10 and sum(r.rows for r in out) == 100


def test_matchup_probability_sums_to_one(spark):
    df = spark.createDataFrame([("g", 1, 2, 0.3), ("g", 2, 1, 0.5), ("h", 1, 2, 0.0), ("h", 2, 1, 0.0)],
                               "game_id string, team_id long, opponent_team_id long, p double")
    out = {(r.game_id, r.team_id): r.p_norm for r in M.matchup_probability(df).collect()}
    assert out[("g", 1)] + out[("g", 2)] == pytest.approx(1.0)
    assert out[("h", 1)] == 0.0


def test_quantiles_distributed_path_matches_summary_path(spark, monkeypatch):
    import numpy as np
    from formmart.operators import quantiles as Q
    vals = [float(v) for v in np.random.default_rng(7).normal(0, 1, 3000)]
    df = spark.createDataFrame([(v, v * 2) for v in vals], "x double, y double")
    probs = [0.1, 0.5, 0.9]
    small = Q.exact_quantiles(df, ["x", "y"], probs)
    monkeypatch.setattr(Q, "BRACKET_VALUES", 100)
    assert Q.exact_quantiles(df, ["x", "y"], probs) == small
    big = Q.exact_quantiles(df, ["x", "y"], probs, buckets=16)
    want = {c: list(np.percentile([v if c == "x" else 2 * v for v in vals], [p * 100 for p in probs]))
            for c in ("x", "y")}
    for c in ("x", "y"):
        assert small[c] == pytest.approx(want[c]) and big[c] == pytest.approx(want[c])


def test_combined_point_metrics_match_separate(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.4), (0, 0.7), (1, 0.5)], "y int, p double")
    both = M.accuracy_and_log_loss(df).first()
    assert both["accuracy"] == M.accuracy(df).first()[0]
    assert both["log_loss"] == pytest.approx(M.log_loss(df).first()[0], rel=1e-15)


def test_auc_of_many_ranges(spark):
    import numpy as np
    from formmart.operators import metrics as MM
    rng = np.random.default_rng(3)
    p = rng.random(2000)
    y = (rng.random(2000) < p).astype(int)
    df = spark.createDataFrame([(int(a), float(round(b, 3))) for a, b in zip(y, p)], "y int, p double")
    small = MM.roc_auc(df).first()[0]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        big = MM.roc_auc(df).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    pos, neg = p.round(3)[y == 1], p.round(3)[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert small == pytest.approx(want, rel=1e-12) and big == pytest.approx(want, rel=1e-12)
