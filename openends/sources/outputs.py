"""Write run results and read feature tables back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openends.config import KEY_COLUMNS
from openends.plans.predict import PredictResult
from openends.plans.train import TrainRun

# Column names of written tables.
DISPLAY = {inside: shown for shown, inside in KEY_COLUMNS.items()} | {"theme": "Theme"}


def displayed(table: DataFrame) -> DataFrame:
    """Inside names to the names of the response contract."""
    return table.withColumnsRenamed({c: DISPLAY[c] for c in table.columns if c in DISPLAY})


def write_csv(table: DataFrame, path: str) -> None:
    displayed(table).write.mode("overwrite").option("header", True).csv(path)


def write_json(table: DataFrame, path: str) -> None:
    displayed(table).write.mode("overwrite").json(path)


def write_prediction(result: PredictResult, folder: str) -> None:
    """Feature tables, quality report, topic labels and judge report."""
    write_csv(result.ad_features, f"{folder}/ad_level_features.csv")
    write_csv(result.respondent_features, f"{folder}/respondent_level_features.csv")
    write_csv(result.quality_report, f"{folder}/qc_report.csv")
    if result.topic_labels is not None:
        write_json(result.topic_labels, f"{folder}/topic_labels.json")
    if result.judge_report is not None:
        write_json(result.judge_report, f"{folder}/judge_report.json")
        write_csv(result.judge_report, f"{folder}/judge_report.csv")


def write_details(result: PredictResult, folder: str) -> None:
    """What a run counted, and the shares of all topics, one row per ad and topic."""
    if result.counts is not None:
        write_csv(result.counts, f"{folder}/run_counts.csv")
    if result.topic_shares is not None:
        write_csv(result.topic_shares, f"{folder}/topic_shares.csv")


def write_training(run: TrainRun, folder: str) -> None:
    """Everything a predict run writes, and the model report."""
    write_prediction(run.prediction, folder)
    report = f"{folder}/model_report"
    if run.scores is not None:
        write_json(run.scores, f"{report}/fold_scores.json")
    if run.report is not None:
        write_json(run.report, f"{report}/summary.json")
    for task, table in run.drivers.items():
        write_json(table, f"{report}/top_drivers_{task}.json")
    if run.learning_curve is not None:
        write_json(run.learning_curve, f"{report}/learning_curve.json")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A written feature CSV with inside names; all features are numbers."""
    raw = spark.read.option("header", True).csv(path)
    inside = {shown: name for name, shown in DISPLAY.items()}
    named = raw.withColumnsRenamed({c: inside[c] for c in raw.columns if c in inside})
    texts = {"ad_id", "respondent_id", "brand", "platform"}
    return named.withColumns(
        {c: F.col(c).cast("double") for c in named.columns if c not in texts}
    )
