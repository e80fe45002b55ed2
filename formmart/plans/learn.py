"""Model fitting, evaluation, selection and batch scoring with MLlib.

Mapping of the source's estimators: median imputation fitted on the train
split (exact medians, midpoint for even counts) is baked into the pipeline as a
``SQLTransformer``; logistic regression with an L2 penalty of strength 1 on the
summed loss becomes ``regParam = 1 / n_train`` on Spark's mean loss, without
standardization; the histogram gradient-boosting model becomes a seeded
``GBTClassifier`` of the same size (similar family, not identical numbers).
It is fitted on all training rows; ``early_stopping`` asks for a held-out share
instead, at any size.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formmart import schemas as S
from formmart.operators import metrics as M
from formmart.operators.quantiles import exact_medians

ID_COLS = ("game_id", "game_date", "team_id", "opponent_team_id", "is_home", "y_win")


def feature_columns(df: DataFrame) -> list[str]:
    """Every column except identifiers, season, date and the label."""
    return [c for c in df.columns if c not in S.NON_FEATURES]


def impute(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Fill nulls of each column with its (train) median; columns without one are left as is."""
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c)
                       if c in medians and medians[c] is not None else F.col(c) for c in df.columns])


def _imputer_sql(features: Sequence[str], medians: dict[str, float]) -> str:
    cols = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), CAST({medians[c]!r} AS DOUBLE)) AS `_f_{c}`"
                     for c in features)
    return f"SELECT *, {cols} FROM __THIS__"


EARLY_STOP_FRACTION = 0.1  # of the training rows, where early stopping is asked for
_VAL = "_fm_es_val"


def build_pipeline(kind: str, features: Sequence[str], medians: dict[str, float], n_train: int,
                   seed: int = 42, early_stopping: bool = False) -> Pipeline:
    stages = [SQLTransformer(statement=_imputer_sql(features, medians)),
              VectorAssembler(inputCols=[f"_f_{c}" for c in features], outputCol="features",
                              handleInvalid="keep")]
    if kind == "lr":
        est = LogisticRegression(featuresCol="features", labelCol="label", maxIter=2000,
                                 regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                                 standardization=False, tol=1e-6)
    elif kind == "gbt":
        est = GBTClassifier(featuresCol="features", labelCol="label", maxIter=100, stepSize=0.1, maxDepth=5,
                            maxBins=255, minInstancesPerNode=20, seed=seed)
        if early_stopping:
            est = est.setValidationIndicatorCol(_VAL)
            est.set(est.validationTol, 1e-7)
    else:
        raise ValueError(kind)
    return Pipeline(stages=[*stages, est])


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("y_win").cast("double"))


def proba(model: PipelineModel, df: DataFrame, out: str = "pred_win_proba") -> DataFrame:
    """Class-1 probability of each row, next to its identifiers."""
    scored = model.transform(df)
    keep = [c for c in ID_COLS if c in df.columns]
    return scored.select(*keep, vector_to_array("probability")[1].alias(out))


def evaluate(scored: DataFrame, y: str = "y_win", p: str = "pred_win_proba") -> dict[str, float | None]:
    point = M.accuracy_and_log_loss(scored, y, p).first()
    auc = M.roc_auc(scored, y, p).first()[0]
    return {"roc_auc": auc, "logloss": point["log_loss"], "accuracy": point["accuracy"]}


@dataclass
class TrainResult:
    models: dict[str, PipelineModel]
    features: list[str]
    medians: dict[str, float]
    skipped: list[str]
    metrics: dict[str, float | None]
    best: str
    dataset_view: str
    n_train: int
    extra: dict = field(default_factory=dict)

    def metrics_frame(self, spark: SparkSession) -> DataFrame:
        rows = []
        for k, v in self.metrics.items():
            model, split, metric = k.split("_", 2)
            rows.append((model, split, metric, None if v is None else float(v)))
        return spark.createDataFrame(rows, "model string, split string, metric string, value double")


def fit_models(split_df: DataFrame, dataset_view: str, seed: int = 42,
               kinds: Sequence[str] = ("lr", "gbt"), early_stopping: bool = False) -> TrainResult:
    """Fit on 'train', evaluate on 'val' and 'test', pick the lowest validation log loss (ties → lr).

    With ``early_stopping`` the boosted model holds out the training rows whose
    hash of (game, team, seed) falls in a tenth, and stops when their loss does.
    """
    df = with_label(split_df.withColumn("is_home", F.col("is_home").cast("double")))
    features = feature_columns(split_df.drop("split"))
    train = df.where(F.col("split") == "train")
    n_train = train.count()
    med = exact_medians(train, features)
    skipped = [c for c in features if med[c] is None]  # all-null in train: dropped, as the source's imputer does
    features = [c for c in features if med[c] is not None]
    part = F.pmod(F.xxhash64("game_id", "team_id", F.lit(seed)), F.lit(1000))
    train = train.withColumn(_VAL, part < int(1000 * EARLY_STOP_FRACTION)).persist()
    models, metrics = {}, {}
    try:
        for kind in kinds:
            models[kind] = build_pipeline(kind, features, med, n_train, seed, early_stopping=early_stopping).fit(train)
            for part in ("val", "test"):
                rows = df.where(F.col("split") == part)
                for name, v in evaluate(proba(models[kind], rows)).items():
                    metrics[f"{kind}_{part}_{name}"] = v
    finally:
        train.unpersist()
    scored = [(k, metrics.get(f"{k}_val_logloss")) for k in kinds]
    scored = [(k, v if v is not None else float("inf")) for k, v in scored]
    best = min(scored, key=lambda t: t[1])[0]  # stable: lr wins ties
    return TrainResult(models, features, {c: med[c] for c in features}, skipped, metrics, best,
                       dataset_view, n_train)


def coefficients(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    lr = model.stages[-1]
    return list(zip(features, [float(x) for x in lr.coefficients]))


def fit_certificate(train: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(term, coef, gradient, scale): the logistic fit's stated objective, differentiated over the training rows.

    The objective is the mean log loss plus half the squared coefficients (not
    the intercept) divided by the number of rows; at its minimum the gradient is
    zero.  One pass sums p - y times each imputed feature; ``scale`` is the root
    mean square of the feature, by which a gradient compares with others.
    """
    lr = model.stages[-1]
    x = F.col("_x")
    rows = model.transform(with_label(train)).select(
        vector_to_array("features").alias("_x"), (vector_to_array("probability")[1] - F.col("label")).alias("_r"))
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("_r").alias("g"),
                    *[F.avg(x[i] * F.col("_r")).alias(f"g{i}") for i in range(len(features))],
                    *[F.sqrt(F.avg(x[i] * x[i])).alias(f"s{i}") for i in range(len(features))]).first()
    coefs = [float(c) for c in lr.coefficients]
    terms = [("(intercept)", float(lr.intercept), sums["g"], 1.0)]
    terms += [(f, c, sums[f"g{i}"] + c / sums["n"], sums[f"s{i}"]) for i, (f, c) in enumerate(zip(features, coefs))]
    return train.sparkSession.createDataFrame(terms, "term string, coef double, gradient double, scale double")


# -- artifacts -----------------------------------------------------------------

def save_bundle(res: TrainResult, path: str) -> str:
    """Best model pipeline + one-row metadata (name, feature columns, dataset view)."""
    spark = SparkSession.getActiveSession()
    res.models[res.best].write().overwrite().save(f"{path}/model")
    meta = {"model_name": res.best, "feature_cols": res.features, "dataset_view": res.dataset_view,
            "skipped_cols": res.skipped}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
        f"{path}/meta")
    return path


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return PipelineModel.load(f"{path}/model"), meta


def write_metrics(res: TrainResult, path: str) -> str:
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(res.metrics),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(model, split, metric, value) of a metrics file."""
    rows = [(*name.split("_", 2), None if value is None else float(value))
            for name, value in json.loads(spark.read.text(path).first()[0]).items()]
    return spark.createDataFrame(rows, "model string, split string, metric string, value double")


def write_predictions(pred: DataFrame, path: str) -> str:
    pred.write.mode("overwrite").option("header", True).csv(path)
    return path


def score(spark: SparkSession, bundle_path: str, datasets: dict[str, DataFrame]) -> DataFrame:
    """Score the dataset view the model was trained on (recorded in its metadata)."""
    model, meta = load_bundle(spark, bundle_path)
    ds = datasets[meta["dataset_view"]].withColumn("is_home", F.col("is_home").cast("double"))
    return proba(model, ds).withColumn("is_home", F.col("is_home").cast("boolean"))
