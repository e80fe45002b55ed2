"""Registered queries for model fitting, artifacts, scoring and the catalog.

Fitted numbers have no oracle; what SQL can say about the artifacts (rows, keys,
labels, ranges, agreement, a vanishing gradient) has one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from formmart.plans import learn as L
from formmart.plans.fixture_mart import mart_for
from formmart.plans.oracle_sql import with_views
from formmart.plans.q_profile import DS, FEATURES, SPLIT_CTE
from formmart.plans.registry import register
from formmart.plans.train import train_mart
from formmart.session import scratch_path


def run_of(spark, sf_dir):
    """The training run of the fixture's mart, once per mart."""
    m = mart_for(spark, sf_dir)
    return m.memo("train_run", lambda: train_mart(m, scratch_path(spark, "artifacts")))


def trained(spark, sf_dir):
    run = run_of(spark, sf_dir)
    return run.result, run.out_dir, run.split


def _scores(spark, sf_dir, kind):
    res, _, split = trained(spark, sf_dir)
    rows = split.withColumn("is_home", F.col("is_home").cast("double"))
    return L.proba(res.models[kind], rows).withColumn("is_home", F.col("is_home").cast("boolean"))


@register("ml_lr_scores")
def q_ml_lr_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "lr")


@register("ml_gbt_scores")
def q_ml_gbt_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "gbt")


@register("ml_metrics")
def q_ml_metrics(spark, sf_dir):
    res, base, _ = trained(spark, sf_dir)
    return res.metrics_frame(spark)


@register("ml_best")
def q_ml_best(spark, sf_dir):
    res, base, _ = trained(spark, sf_dir)
    return spark.createDataFrame(
        [(res.best, res.dataset_view, len(res.features), res.n_train, res.metrics.get(f"{res.best}_val_logloss"))],
        "model_name string, dataset_view string, n_features int, n_train bigint, val_logloss double")


@register("ml_coefficients")
def q_ml_coefficients(spark, sf_dir):
    """Logistic-regression coefficients: the 20 largest and the 20 smallest."""
    res, _, _ = trained(spark, sf_dir)
    coefs = spark.createDataFrame(L.coefficients(res.models["lr"], res.features), "feature string, coef double")
    top = coefs.orderBy(F.col("coef").desc(), "feature").limit(20).withColumn("end", F.lit("top"))
    bottom = coefs.orderBy(F.col("coef").asc(), "feature").limit(20).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


@register("ml_model_roundtrip")
def q_ml_model_roundtrip(spark, sf_dir):
    """Saved bundle reloaded: its scores of each split compared with those of the fitted model."""
    res, base, split = trained(spark, sf_dir)
    model, meta = L.load_bundle(spark, f"{base}/bundle")
    rows = split.withColumn("is_home", F.col("is_home").cast("double"))
    keys = ["game_id", "team_id"]
    fitted = L.proba(res.models[res.best], rows, "fitted").select(*keys, "fitted")
    reloaded = L.proba(model, rows, "reloaded").select(*keys, "reloaded")
    both = split.select(*keys, "split").join(fitted, keys, "left").join(reloaded, keys, "left")
    differs = ~F.col("fitted").eqNullSafe(F.col("reloaded"))
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.count("reloaded").alias("rows_scored"), F.count_if(differs).alias("rows_differing"),
        F.max(F.abs(F.col("fitted") - F.col("reloaded"))).alias("largest_difference")).select(
        F.lit(meta["model_name"]).alias("model_name"), F.lit(meta["dataset_view"]).alias("dataset_view"),
        F.lit(len(meta["feature_cols"])).alias("n_features"), "split", "rows", "rows_scored", "rows_differing", "largest_difference")


@register("ml_roundtrip_counts", with_views(
    SPLIT_CTE + ' SELECT split, count(*) AS "rows", count(*) AS rows_scored, CAST(0 AS BIGINT) AS rows_differing FROM sp GROUP BY split'))
def q_ml_roundtrip_counts(spark, sf_dir):
    """Every row of every split is scored by the reloaded model as by the fitted one."""
    return q_ml_model_roundtrip(spark, sf_dir).select("split", "rows", "rows_scored", "rows_differing")


@register("ml_features", with_views(
    SPLIT_CTE + " SELECT feature, ordinal, non_null_rows FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS ordinal, count({c}) AS non_null_rows FROM sp WHERE split = 'train'"
        for i, c in enumerate(FEATURES)) + ")"))
def q_ml_features(spark, sf_dir):
    """The model's inputs in order, with their training rows."""
    res, _, split = trained(spark, sf_dir)
    order = spark.createDataFrame(list(enumerate(res.features)), "ordinal int, feature string")
    counts = split.where(F.col("split") == "train").agg(*[F.count(c).alias(c) for c in res.features])
    return order.join(counts.unpivot([], res.features, "feature", "non_null_rows"), "feature")


#: Root mean squares of one feature that its gradient may be off by.
CERTIFIED = 1e-3


@register("ml_fit_certificate", with_views(
    "SELECT term, true AS stationary, n_train FROM (VALUES " + ", ".join(f"('{c}')" for c in ["(intercept)", *FEATURES])
    + f") t(term), (SELECT count(*) - CAST(round_even(count(*) * 0.2, 0) + round_even(count(*) * 0.1, 0) AS BIGINT) AS n_train FROM {DS})"))
def q_ml_fit_certificate(spark, sf_dir):
    """The logistic fit's gradient vanishes in every term, up to a tolerance on the feature's scale."""
    res, _, split = trained(spark, sf_dir)
    train = split.where(F.col("split") == "train").withColumn("is_home", F.col("is_home").cast("double"))
    terms = L.fit_certificate(train, res.models["lr"], res.features)
    return terms.select("term", (F.abs("gradient") <= CERTIFIED * F.col("scale")).alias("stationary"),
                        F.lit(res.n_train).cast("bigint").alias("n_train"))


@register("metrics_file", with_views(
    "SELECT model, split, metric, true AS in_range, n FROM (VALUES ('lr'), ('gbt')) a(model), (VALUES ('val'), ('test')) b(split), "
    "(VALUES ('roc_auc'), ('logloss'), ('accuracy')) c(metric), (SELECT count(*) AS n FROM " + DS + ")"))
def q_metrics_file(spark, sf_dir):
    """The metrics file read back: each metric of each model and split in its range, over n rows in all."""
    run = run_of(spark, sf_dir)
    top = F.when(F.col("metric") == "logloss", F.lit(40.0)).otherwise(F.lit(1.0))
    return run.metrics().select("model", "split", "metric", F.col("value").between(F.lit(0.0), top).alias("in_range"),
                                F.lit(run.split.count()).cast("bigint").alias("n"))


_SCORED = "game_id, game_date, team_id, opponent_team_id, is_home, CAST(y_win AS INTEGER) AS y_win, true AS is_probability"


def _keys(scored):
    p = F.col("pred_win_proba")
    return scored.select("game_id", "game_date", "team_id", "opponent_team_id", "is_home", F.col("y_win").cast("int").alias("y_win"),
                         (p.isNotNull() & p.between(0.0, 1.0)).alias("is_probability"))


@register("sink_predictions_keys", with_views(SPLIT_CTE + f" SELECT {_SCORED} FROM sp WHERE split = 'test'"))
def q_sink_predictions_keys(spark, sf_dir):
    """Keys and labels of the written test predictions."""
    return _keys(run_of(spark, sf_dir).test_predictions())


@register("score_full_keys", with_views(f"SELECT {_SCORED} FROM {DS}"))
def q_score_full_keys(spark, sf_dir):
    """Keys and labels of the whole history, scored by the saved bundle."""
    return _keys(run_of(spark, sf_dir).score())


@register("sink_predictions")
def q_sink_predictions(spark, sf_dir):
    """Test-set predictions as written (CSV with header), read back."""
    return run_of(spark, sf_dir).test_predictions()


@register("score_full")
def q_score_full(spark, sf_dir):
    """Batch scoring of the full history with the saved bundle; written as CSV and returned."""
    out = run_of(spark, sf_dir).score()
    path = L.write_predictions(out, scratch_path(spark, "artifacts", "predictions_full"))
    return spark.read.option("header", True).schema(out.schema).csv(path)


@register("catalog_listing")
def q_catalog_listing(spark, sf_dir):
    """Views of the mart as created in the session catalog, ordered by type and name."""
    m = mart_for(spark, sf_dir)
    m.register_views()
    rows = [(t.tableType, t.name) for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("v_")]
    return spark.createDataFrame(sorted(rows), "table_type string, table_name string")
