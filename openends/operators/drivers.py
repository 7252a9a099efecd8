"""Which features drive a model: permutation importance and tree importance."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openends.operators.ranks import shuffled_positions
from openends.operators.training import TrainResult


def _quality(regression: bool) -> Column:
    if regression:
        miss = F.col("label") - F.col("prediction")
        return -F.avg(miss * miss)
    return F.avg((F.col("label") == F.col("prediction")).cast("double"))


def permuted_rows(rows: DataFrame, n_features: int, seed: int) -> DataFrame:
    """One copy of every row per feature, that feature's value taken from another row.

    Rows stand in a seeded random order on a circle; each feature shifts the circle
    by its own distance, so every row gets exactly one partner per feature. The
    partner's value comes by an equi-join on position and feature.
    """
    placed = shuffled_positions(
        rows.select("ad_id", "label", vector_to_array("features").alias("values")),
        "ad_id",
        seed,
        "position",
    )
    n_rows = rows.agg(F.count(F.lit(1))).scalar()
    shift = 1 + F.pmod(F.xxhash64(F.lit(seed), F.col("slot")), F.greatest(n_rows - 1, F.lit(1)))
    copies = placed.withColumn(
        "slot", F.explode(F.sequence(F.lit(0), F.lit(n_features - 1)))
    ).withColumn("partner", F.pmod(F.col("position") + shift, n_rows))
    offered = placed.select(
        F.col("position").alias("partner"), F.posexplode("values").alias("slot", "swapped")
    )
    replaced = F.transform(
        "values", lambda x, i: F.when(i == F.col("slot"), F.col("swapped")).otherwise(x)
    )
    return copies.join(offered, ["partner", "slot"]).select(
        "ad_id", "slot", "label", array_to_vector(replaced).alias("features")
    )


def permutation_importance(result: TrainResult, seed: int = 42) -> DataFrame:
    """Loss of accuracy (or gain in squared error) when a feature is permuted.

    All features are scored by one pass of the model over one table.
    """
    regression = result.task == "regression"
    rows = result.rows.select("ad_id", "label", "features")
    base = result.model.transform(rows).agg(_quality(regression)).scalar()
    permuted = result.model.transform(permuted_rows(rows, len(result.feature_names), seed))
    names = F.array(*[F.lit(n) for n in result.feature_names])
    return permuted.groupBy("slot").agg(_quality(regression).alias("permuted")).select(
        F.element_at(names, F.col("slot") + 1).alias("feature"),
        (base - F.col("permuted")).alias("importance"),
    )


def top_drivers(importance: DataFrame, top_n: int = 15) -> DataFrame:
    """The most important features, ties by name."""
    return importance.orderBy(F.desc("importance"), "feature").limit(top_n)


def tree_importance(result: TrainResult) -> DataFrame:
    """Impurity importance of a tree model, one row per feature."""
    weights = result.model.featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(result.feature_names, weights, strict=True)]
    return result.rows.sparkSession.createDataFrame(rows, "feature string, importance double")
