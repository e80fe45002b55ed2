"""Training end to end: four raw exports → mart → split → models → artifacts that are read back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formmart.operators.split import time_split
from formmart.plans import learn as L
from formmart.plans.mart import Mart
from formmart.session import input_bytes, size_for_input
from formmart.sources.csv import build_standard_tables

PREDICTIONS = ("game_id string, game_date date, team_id bigint, opponent_team_id bigint, is_home boolean, "
               "y_win int, pred_win_proba double")


@dataclass
class TrainRun:
    """What a run fitted and where its artifacts are."""
    spark: SparkSession
    result: L.TrainResult
    split: DataFrame
    out_dir: str
    mart: Mart

    def metrics(self) -> DataFrame:
        """(model, split, metric, value) from the metrics file."""
        return L.read_metrics(self.spark, f"{self.out_dir}/metrics")

    def test_predictions(self) -> DataFrame:
        """The predictions of the test rows as written."""
        return self.spark.read.option("header", True).schema(PREDICTIONS).csv(f"{self.out_dir}/test_predictions")

    def score(self) -> DataFrame:
        """The whole history scored by the saved bundle."""
        views = {"v_training_dataset": self.mart.training_dataset()}
        if self.mart.tables.has_players:
            views["v_training_dataset_enriched"] = self.mart.training_dataset_enriched()
        return L.score(self.spark, f"{self.out_dir}/bundle", views)


def train_mart(mart: Mart, out_dir: str, seed: int = 42, kinds=("lr", "gbt")) -> TrainRun:
    """Split the mart's dataset by time, fit and compare the models, write bundle, metrics and test predictions."""
    split = mart.memo("time_split", lambda: time_split(mart.dataset()))
    result = L.fit_models(split, mart.dataset_view, seed, kinds)
    L.save_bundle(result, f"{out_dir}/bundle")
    L.write_metrics(result, f"{out_dir}/metrics")
    test = L.with_label(split.where(F.col("split") == "test").withColumn("is_home", F.col("is_home").cast("double")))
    pred = L.proba(result.models[result.best], test).withColumn("is_home", F.col("is_home").cast("boolean"))
    L.write_predictions(pred, f"{out_dir}/test_predictions")
    return TrainRun(mart.spark, result, split, out_dir, mart)


def train(spark: SparkSession, paths: dict[str, str], out_dir: str, seed: int = 42, kinds=("lr", "gbt"),
          n: int = 5) -> TrainRun:
    """Train on raw CSV exports: ``paths`` has teams and games, and for star features players and player_games.

    Partition sizes follow the input where the session doesn't set them.
    """
    size_for_input(spark, input_bytes(spark, [p for p in paths.values() if p]))
    tables = build_standard_tables(spark, paths["teams"], paths["games"], paths.get("players"), paths.get("player_games"))
    return train_mart(Mart(spark, tables, n=n), out_dir, seed, kinds)
