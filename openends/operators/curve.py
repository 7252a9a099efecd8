"""How accuracy depends on the number of conversations per ad."""

from __future__ import annotations

import itertools
import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends.operators import forest
from openends.operators.ranks import sample_per_group
from openends.operators.training import (
    cut_lineage,
    encode_target,
    feature_names,
    group_folds,
    task_labels,
    train,
)

log = logging.getLogger("openends")

CELL = ["n_per_ad", "repeat"]
CONVERSATION = ["ad_id", "respondent_id"]


def sampled_responses(
    responses: DataFrame, grid: Sequence[int], n_repeats: int, seed: int
) -> DataFrame:
    """Sampled conversations of every repeat with their rank; at most ads x repeats x max(grid).

    A conversation is a pair of ad and respondent, however many rows it has.
    """
    repeats = responses.select(*CONVERSATION).distinct().withColumn(
        "repeat", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1)))
    )
    return sample_per_group(
        repeats,
        ["ad_id", "repeat"],
        ["respondent_id"],
        max(grid),
        F.lit(seed) + F.col("repeat"),
    )


def sampled_once(responses: DataFrame, sample: DataFrame) -> DataFrame:
    """Responses that are part of any sample; they need a score only once."""
    return responses.join(sample.select(*CONVERSATION).distinct(), CONVERSATION, "left_semi")


def with_cells(rows: DataFrame, sample: DataFrame, grid: Sequence[int]) -> DataFrame:
    """Copy rows into every (n_per_ad, repeat) cell they are sampled for.

    The sample of n conversations is the first n of the seeded order, so a conversation
    of rank r belongs to all sizes of at least r.
    """
    sizes = F.array(*[F.lit(n) for n in grid])
    cells = sample.withColumn(
        "n_per_ad", F.explode(F.filter(sizes, lambda n: n >= F.col("sample_rank")))
    ).drop("sample_rank")
    return rows.join(cells, CONVERSATION)


def _cell_rows(
    cell_features: DataFrame, labels: DataFrame, task: str, n_repeats: int, n_splits: int, seed: int
) -> tuple[DataFrame, int]:
    """(n_per_ad, repeat, ad_id, label, fold, x) of the labelled ads of all cells, and the number of classes.

    The ads of a repeat are dealt to folds once, for all sizes.
    """
    names = feature_names(cell_features.drop(*CELL))
    rows = cell_features.join(task_labels(labels, task).select("ad_id", "target"), "ad_id")
    rows = cut_lineage(encode_target(rows.filter("target IS NOT NULL")))
    n_classes = rows.agg(F.max("label")).first()[0]
    folds = None
    for repeat in range(n_repeats):
        ads = rows.filter(F.col("repeat") == repeat).select("ad_id").distinct()
        splits = min(n_splits, ads.count())
        if splits < 2:
            log.warning("repeat %d left out: fewer than 2 labelled ads", repeat)
            continue
        part = group_folds(ads, splits, seed + repeat).withColumn("repeat", F.lit(repeat))
        folds = part if folds is None else folds.unionByName(part)
    if folds is None:
        return rows.limit(0).withColumns({"fold": F.lit(0), "x": F.array(F.lit(0.0))}), 1
    x = F.array(*[F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0)) for name in names])
    joined = rows.join(folds, ["ad_id", "repeat"]).withColumn("x", x)
    return cut_lineage(joined.select(*CELL, "ad_id", "label", "fold", "x")), int(n_classes) + 1


def cell_accuracies(
    cell_features: DataFrame,
    labels: DataFrame,
    n_repeats: int,
    task: str = "3class",
    n_splits: int = 5,
    seed: int = 42,
    n_trees: int = 300,
) -> DataFrame:
    """(n_per_ad, repeat, accuracy): mean fold accuracy of every cell, all fitted by one plan."""
    rows, n_classes = _cell_rows(cell_features, labels, task, n_repeats, n_splits, seed)
    scored = forest.cross_validate(rows, CELL, n_classes, n_trees, seed)
    right = (F.col("prediction") == F.col("label")).cast("double")
    folds = scored.groupBy(*CELL, "fold").agg(F.avg(right).alias("score"))
    return folds.groupBy(*CELL).agg(F.avg("score").alias("accuracy"))


def learning_curve(
    cell_features: DataFrame,
    labels: DataFrame,
    grid: Sequence[int],
    n_repeats: int,
    task: str = "3class",
    model_name: str = "random_forest",
    n_splits: int = 5,
    seed: int = 42,
    n_trees: int | None = None,
    parallelism: int = 8,
) -> DataFrame:
    """Mean and population std of grouped accuracy per number of conversations.

    `cell_features` holds the ad features of all cells, computed by one plan; forests of all cells
    and folds are fitted by one plan as well. Other models go cell by cell, `parallelism` cells at
    a time. A cell that cannot be scored is left out; `n_repeats` tells how many stand behind a mean.
    """
    if model_name == "random_forest" and task != "regression":
        accuracies = cell_accuracies(
            cell_features, labels, n_repeats, task, n_splits, seed, n_trees or 300
        )
        wanted = F.col("n_per_ad").isin(list(grid))
        return _curve_table(accuracies.filter(wanted).withColumnRenamed("n_per_ad", "n_conversations"))

    def cell_accuracy(cell: tuple[int, int]) -> tuple[int, int, float] | None:
        n, repeat = cell
        features = cell_features.filter((F.col("n_per_ad") == n) & (F.col("repeat") == repeat))
        try:
            result = train(
                features.drop(*CELL), labels, task, model_name, n_splits, seed + repeat, n_trees,
                final=False,
            )
        except ValueError as error:
            log.warning("cell n=%d repeat=%d left out: %s", n, repeat, error)
            return None
        return n, repeat, result.mean_score

    with ThreadPoolExecutor(parallelism) as pool:
        found = pool.map(cell_accuracy, itertools.product(grid, range(n_repeats)))
        scores = [score for score in found if score is not None]
    table = cell_features.sparkSession.createDataFrame(
        scores, "n_conversations int, repeat int, accuracy double"
    )
    return _curve_table(table)


def _curve_table(table: DataFrame) -> DataFrame:
    return table.groupBy("n_conversations").agg(
        F.count("accuracy").alias("n_repeats"),
        F.avg("accuracy").alias("mean_accuracy"),
        F.stddev_pop("accuracy").alias("std_accuracy"),
    )
