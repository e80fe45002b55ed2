"""Distributed metric/split operators vs brute force on the small fixture."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from formmart.operators import metrics as M
from formmart.operators.split import split_counts, time_split
from formmart.plans.fixture_mart import mart_for


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    ds = mart_for(spark, sf_dir).dataset()
    return ds.withColumn("y", F.col("y_win")).withColumn(
        "p", (F.col("winrate_l5") + 1 - F.col("opp_winrate_l5")) / 2)


def test_auc_equals_pair_count(scored):
    rows = scored.select("y", "p").collect()
    pos = np.array([r.p for r in rows if r.y == 1])
    neg = np.array([r.p for r in rows if r.y == 0])
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert M.roc_auc(scored).first()[0] == pytest.approx(wins / (len(pos) * len(neg)), rel=1e-12)


def test_calibration_equals_numpy(scored):
    rows = scored.select("y", "p").collect()
    y = np.array([r.y for r in rows], dtype=float)
    p = np.array([r.p for r in rows])
    edges = np.percentile(p, np.linspace(0, 1, 11) * 100)
    ids = np.searchsorted(edges[1:-1], p)  # side='left': count of interior edges < p
    want = {}
    for b in np.unique(ids):
        sel = ids == b
        want[int(b)] = (p[sel].mean(), y[sel].mean(), int(sel.sum()))
    got = {r.bin: (r.mean_predicted, r.fraction_positive, r.rows) for r in M.calibration(scored).collect()}
    assert set(got) == set(want)
    for b in want:
        assert got[b][0] == pytest.approx(want[b][0]) and got[b][1] == pytest.approx(want[b][1])
        assert got[b][2] == want[b][2]


def test_split_equals_sort_and_slice(spark, sf_dir):
    ds = mart_for(spark, sf_dir).dataset()
    out = time_split(ds).select("game_date", "game_id", "team_id", "split").collect()
    ordered = sorted(out, key=lambda r: (r.game_date, r.game_id, r.team_id))
    n_train, n_val, n_test = split_counts(len(ordered))
    want = ["train"] * n_train + ["val"] * n_val + ["test"] * n_test
    assert [r.split for r in ordered] == want
