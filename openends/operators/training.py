"""Grouped cross-validation of ad-level models, and the final fit."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openends.operators import forest
from openends.operators.forest import ForestModel
from openends.operators.ranks import shuffled_positions
from openends.sources.shared import cut_lineage

log = logging.getLogger("openends")

# Columns of the ad table that are no model input.
NOT_FEATURES = ["ad_id", "n_conversations"]


@dataclass(frozen=True)
class TrainResult:
    """Scores per held-out fold and the model fitted on all labelled ads."""

    task: str
    model_name: str
    metric: str
    fold_scores: list[float]
    mean_score: float
    std_score: float
    feature_names: list[str]
    model: Model | ForestModel | None
    rows: DataFrame


def feature_names(features: DataFrame) -> list[str]:
    """Model inputs in table order."""
    return [c for c in features.columns if c not in NOT_FEATURES]


def labelled_features(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Ads with a label; missing features become 0."""
    return features.join(labels, "ad_id").fillna(0.0, feature_names(features))


def unlabelled_ads(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Ads that a training run leaves out because they have no label."""
    return features.select("ad_id").join(labels.select("ad_id"), "ad_id", "left_anti")


def task_labels(labels: DataFrame, task: str) -> DataFrame:
    """(ad_id, target) for '3class', 'binary' or 'regression'.

    Binary splits at the median score of all labels, the median itself counting
    as top; without scores it keeps the Strong and Weak ads only.
    """
    if task == "3class":
        return labels.select("ad_id", F.col("band").alias("target"))
    if task == "regression":
        if "score" not in labels.columns:
            raise ValueError("regression needs labels with a score")
        return labels.select("ad_id", F.col("score").alias("target"))
    if task != "binary":
        raise ValueError(f"unknown task {task!r}")
    if "score" not in labels.columns:
        return labels.filter(F.col("band").isin("Strong", "Weak")).select(
            "ad_id", F.col("band").alias("target")
        )
    median = labels.agg(F.median("score")).scalar()
    top = F.when(F.col("score") >= median, "Top").otherwise("Bottom")
    return labels.select("ad_id", top.alias("target"))


def encode_target(rows: DataFrame) -> DataFrame:
    """Add `label`: the target's position among the sorted targets."""
    indexer = StringIndexer(inputCol="target", outputCol="label", stringOrderType="alphabetAsc")
    return indexer.fit(rows).transform(rows)


def group_folds(ads: DataFrame, n_splits: int, seed: int = 42) -> DataFrame:
    """A fold per distinct ad: seeded order, dealt out in turn, sizes differ by one."""
    positions = shuffled_positions(ads.select("ad_id").distinct(), "ad_id", seed, "position")
    return positions.select("ad_id", (F.col("position") % n_splits).cast("int").alias("fold"))


def balanced_weights(rows: DataFrame) -> DataFrame:
    """Add weight n / (classes * n_class), as in balanced class weights."""
    per_class = rows.groupBy("target").agg(F.count(F.lit(1)).alias("_n"))
    overall = per_class.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"))
    weight = overall.select(F.col("n") / F.col("k")).scalar() / F.col("_n")
    # One row per class of the label domain.
    return rows.join(F.broadcast(per_class), "target").withColumn("weight", weight).drop("_n")


def fold_accuracy(predictions: DataFrame) -> DataFrame:
    """Share of correct predictions per fold."""
    right = (F.col("prediction") == F.col("label")).cast("double")
    return predictions.groupBy("fold").agg(F.avg(right).alias("score"))


def fold_r2(predictions: DataFrame) -> DataFrame:
    """R squared per fold; NULL when the fold's labels are constant."""
    miss = F.col("label") - F.col("prediction")
    error = F.sum(miss * miss)
    spread = F.var_pop("label") * F.count("label")
    return predictions.groupBy("fold").agg((1.0 - F.try_divide(error, spread)).alias("score"))


def score_summary(scores: DataFrame) -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return scores.agg(
        F.avg("score").alias("mean_score"),
        F.stddev_pop("score").alias("std_score"),
        F.count("score").alias("n_folds"),
    )


def make_classifier(name: str, seed: int, n_trees: int | None, n_classes: int):
    """Boosted trees (100, depth 3); forests are `operators/forest.py`."""
    if name == "gradient_boosting":
        boosted = GBTClassifier(maxIter=n_trees or 100, maxDepth=3, stepSize=0.1, seed=seed)
        # Boosting in Spark has two classes; more become one model per class.
        return boosted if n_classes <= 2 else OneVsRest(classifier=boosted)
    raise ValueError(f"unknown model {name!r}")


def make_regressor(name: str, seed: int, n_trees: int | None):
    """Boosted trees (100, depth 3); forests are `operators/forest.py`."""
    if name == "gradient_boosting":
        return GBTRegressor(maxIter=n_trees or 100, maxDepth=3, stepSize=0.1, seed=seed)
    raise ValueError(f"unknown model {name!r}")


def _splits(n_ads: int, n_splits: int) -> int:
    splits = min(n_splits, n_ads)
    if splits < 2:
        raise ValueError(f"need at least 2 labelled ads to cross-validate, got {n_ads}")
    if splits < n_splits:
        log.warning("only %d labelled ads; using %d folds", n_ads, splits)
    return splits


def training_rows(
    features: DataFrame, labels: DataFrame, task: str, n_splits: int, seed: int
) -> tuple[DataFrame, list[str]]:
    """(ad_id, target, label, fold, features) with the names of the inputs.

    The table has one row per ad. It is materialised before the folds are dealt
    out, and again, with the features assembled, for the fits.
    """
    names = feature_names(features)
    rows = cut_lineage(
        labelled_features(features, task_labels(labels, task)).filter("target IS NOT NULL")
    )
    n_ads = rows.select("ad_id").distinct().count()
    splits = _splits(n_ads, n_splits)
    rows = rows.join(group_folds(rows, splits, seed), "ad_id")
    if task == "regression":
        rows = rows.withColumn("label", F.col("target").cast("double"))
    else:
        rows = encode_target(rows)
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    kept = assembled.select("ad_id", "target", "label", "fold", "features")
    return cut_lineage(kept), names


def train(
    features: DataFrame,
    labels: DataFrame,
    task: str = "3class",
    model_name: str = "random_forest",
    n_splits: int = 5,
    seed: int = 42,
    n_trees: int | None = None,
    parallelism: int = 4,
    final: bool = True,
) -> TrainResult:
    """Score a model on held-out groups of ads, then, unless `final` is off, fit it on all.

    Forests are fitted by one plan over all folds (`operators/forest.py`). Of other models `parallelism` fits run at
    the same time; each is a Spark job.
    """
    rows, names = training_rows(features, labels, task, n_splits, seed)
    folds = [r.fold for r in rows.select("fold").distinct().orderBy("fold").collect()]
    regression = task == "regression"
    n_classes = 0 if regression else rows.select("target").distinct().count()

    if model_name == "random_forest":
        x = vector_to_array("features").alias("x")
        table = rows.select(F.lit(0).alias("table"), "ad_id", "label", "fold", x)
        predictions = forest.cross_validate(table, ["table"], n_classes, n_trees or 300, seed)
        model = forest.fit(table, n_classes, n_trees or 300, seed) if final else None
    else:
        predictions, model = _spark_fits(
            rows, folds, regression, n_classes, model_name, seed, n_trees, parallelism, final
        )
    scores = cut_lineage((fold_r2 if regression else fold_accuracy)(predictions))
    fold_scores = [r.score for r in scores.orderBy("fold").collect()]
    summary = score_summary(scores).first()
    return TrainResult(
        task=task,
        model_name=model_name,
        metric="r2" if regression else "accuracy",
        fold_scores=fold_scores,
        mean_score=summary.mean_score,
        std_score=summary.std_score,
        feature_names=names,
        model=model,
        rows=rows,
    )


def _spark_fits(
    rows: DataFrame,
    folds: list[int],
    regression: bool,
    n_classes: int,
    model_name: str,
    seed: int,
    n_trees: int | None,
    parallelism: int,
    final: bool,
) -> tuple[DataFrame, Model | None]:
    """(predictions of the rows held out, model of all rows) by fits of Spark's own, one per fold."""

    def fit(part: DataFrame):
        if regression:
            return make_regressor(model_name, seed, n_trees).fit(part)
        return make_classifier(model_name, seed, n_trees, n_classes).fit(balanced_weights(part))

    def held_out(fold: int) -> DataFrame:
        model = fit(rows.filter(F.col("fold") != fold))
        scored = model.transform(rows.filter(F.col("fold") == fold))
        return scored.select("fold", "label", "prediction")

    with ThreadPoolExecutor(parallelism) as pool:
        whole = pool.submit(fit, rows) if final else None
        parts = list(pool.map(held_out, folds))
        model = whole.result() if whole else None
    predictions = parts[0]
    for part in parts[1:]:
        predictions = predictions.unionByName(part)
    return predictions, model


def fold_table(spark: SparkSession, result: TrainResult) -> DataFrame:
    """The result's fold scores as a table; one row per fold."""
    return spark.createDataFrame(
        [
            (result.task, result.model_name, result.metric, fold, score)
            for fold, score in enumerate(result.fold_scores)
        ],
        "task string, model_name string, metric string, fold int, score double",
    )


def report_table(spark: SparkSession, results: list[TrainResult]) -> DataFrame:
    """Mean and standard deviation of the metric per task; one row per task."""
    return spark.createDataFrame(
        [
            (r.task, r.model_name, r.metric, r.mean_score, r.std_score, len(r.fold_scores))
            for r in results
        ],
        "task string, model_name string, metric string, mean_score double, std_score double, "
        "n_folds int",
    )
