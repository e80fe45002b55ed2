"""Model fitting: quality on a learnable label, artifacts round trip, scoring the recorded view."""

import math

import pytest
from pyspark.sql import functions as F

from formmart.operators.split import time_split
from formmart.plans import learn as L
from formmart.plans.fixture_mart import mart_for
from formmart.session import scratch_path


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    ds = mart_for(spark, sf_dir).training_dataset()
    # a label the features can explain: recent scoring beats the opponent's
    learnable = ds.withColumn("y_win", (F.col("pts_avg_l5") > F.col("opp_pts_avg_l5")).cast("int"))
    split = time_split(learnable)
    return split, L.fit_models(split, "v_training_dataset", kinds=("lr",))


def test_lr_beats_constant_predictor(fitted):
    split, res = fitted
    rate = split.where(F.col("split") == "train").agg(F.avg("y_win")).first()[0]
    constant = -(rate * math.log(rate) + (1 - rate) * math.log(1 - rate))
    assert res.metrics["lr_test_logloss"] < 0.5 * constant
    assert res.metrics["lr_test_accuracy"] > 0.9
    assert res.metrics["lr_test_roc_auc"] > 0.95
    assert res.best == "lr" and res.n_train > 0


def test_bundle_round_trip_and_scoring(spark, sf_dir, fitted):
    _, res = fitted
    path = L.save_bundle(res, scratch_path(spark, "test-bundle"))
    model, meta = L.load_bundle(spark, path)
    assert meta["feature_cols"] == res.features and meta["dataset_view"] == "v_training_dataset"
    ds = mart_for(spark, sf_dir).training_dataset()
    scored = L.score(spark, path, {"v_training_dataset": ds})
    assert scored.count() == ds.count()
    assert scored.where((F.col("pred_win_proba") < 0) | (F.col("pred_win_proba") > 1)).count() == 0


def test_reloaded_model_scores_every_split(spark, sf_dir):
    import __spark_entry__ as E
    rows = {r.split: r for r in E.queries()["ml_model_roundtrip"](spark, sf_dir).collect()}
    want = {r.split: r.rows for r in E.queries()["split_counts"](spark, sf_dir).collect()}
    assert {s: r.rows for s, r in rows.items()} == {s: r.rows_scored for s, r in rows.items()} == want
    assert all(r.rows_differing == 0 and r.largest_difference == 0 for r in rows.values())


def test_imputed_rows_of_every_split(spark, sf_dir):
    import __spark_entry__ as E
    out = E.queries()["ml_imputed_splits"](spark, sf_dir).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in out} == {r.split: r.rows for r in E.queries()["split_counts"](spark, sf_dir).collect()}


def test_train_from_raw_exports(spark, sf_dir):
    """Four CSV exports to artifacts that are read back; the fit's gradient vanishes."""
    from formmart.plans.train import train
    from formmart.sources import csv as CSV
    from formmart.sources import raw_render as R
    t = mart_for(spark, sf_dir).tables
    base = scratch_path(spark, "test-train")
    paths = {"teams": CSV.write_raw_csv(R.raw_teams(t.teams), f"{base}/teams"),
             "games": CSV.write_raw_csv(R.raw_games_matchup(t.games, t.teams), f"{base}/games")}
    run = train(spark, paths, f"{base}/out", seed=1, kinds=("lr",))
    assert run.mart.tables.rejected["games"] and run.result.best == "lr"
    assert {(r.model, r.split, r.metric) for r in run.metrics().collect()} == {
        ("lr", s, m) for s in ("val", "test") for m in ("roc_auc", "logloss", "accuracy")}
    counts = {r.split: r["count"] for r in run.split.groupBy("split").count().collect()}
    assert run.test_predictions().count() == counts["test"] and run.score().count() == sum(counts.values())
    train_rows = run.split.where(F.col("split") == "train").withColumn("is_home", F.col("is_home").cast("double"))
    terms = L.fit_certificate(train_rows, run.result.models["lr"], run.result.features).collect()
    assert len(terms) == len(run.result.features) + 1
    assert all(abs(r.gradient) <= 1e-3 * r.scale for r in terms)


def test_a_moved_coefficient_has_no_certificate(spark, fitted):
    """The certificate tells a fit from one that stopped early."""
    split, res = fitted
    train_rows = split.where(F.col("split") == "train").withColumn("is_home", F.col("is_home").cast("double"))
    early = L.build_pipeline("lr", res.features, res.medians, res.n_train)
    early.getStages()[-1].setMaxIter(1)
    model = early.fit(L.with_label(train_rows))
    terms = L.fit_certificate(train_rows, model, res.features).collect()
    assert any(abs(r.gradient) > 1e-3 * r.scale for r in terms)
