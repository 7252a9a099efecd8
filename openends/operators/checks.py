"""Checks of vectors, anchors and scores. Each gives (check, subject, value, status)."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openends.functions import vectors as vx

# Warning thresholds.
COHESION_LOW = 0.40
SEPARATION_HIGH = 0.85
VARIANCE_FLAT = 0.02
NORM_TOLERANCE = 1e-3
GAP_SMALL = 0.05
COSINE_GUARD = 1e-8


def _result(check: str, subject: Column, value: Column, status: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        subject.cast("string").alias("subject"),
        value.cast("double").alias("value"),
        status.alias("status"),
    ]


def norm_check(vectors: DataFrame) -> DataFrame:
    """Largest distance of a vector's length from 1."""
    worst = vectors.agg(F.max(F.abs(vx.norm(F.col("vector")) - 1.0)).alias("worst"))
    status = F.when(F.col("worst") <= NORM_TOLERANCE, "ok").otherwise("NOT NORMALISED")
    return worst.select(*_result("norms", F.lit("all vectors"), F.col("worst"), status))


def pair_check(probes: DataFrame) -> DataFrame:
    """Similar against unrelated pairs: (probe, kind, left, right) vectors.

    The value is by how much the similar pair is closer than the unrelated one.
    """
    likeness = vx.cosine(F.col("left"), F.col("right"))
    by_probe = probes.groupBy("probe").agg(
        F.avg(F.when(F.col("kind") == "similar", likeness)).alias("similar"),
        F.avg(F.when(F.col("kind") == "unrelated", likeness)).alias("unrelated"),
    )
    gap = F.col("similar") - F.col("unrelated")
    status = F.when(gap <= 0, "NOT DISCRIMINATING").when(gap < GAP_SMALL, "SMALL GAP")
    return by_probe.select(*_result("pairs", F.col("probe"), gap, status.otherwise("ok")))


def cohesion_check(phrase_vectors: DataFrame) -> DataFrame:
    """Mean cosine over all pairs of a construct's phrases, without forming pairs.

    For unit vectors the pair sum is (|sum of vectors|^2 - number of vectors) / 2,
    so one vector aggregate per construct gives the exact mean at any size.
    """
    unit = phrase_vectors.select("construct", vx.normalize(F.col("vector")).alias("unit"))
    sums = unit.groupBy("construct").agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.col("unit")))).alias("total"),
        F.sum(vx.dot(F.col("unit"), F.col("unit"))).alias("squares"),
        F.count(F.lit(1)).alias("n"),
    )
    pair_sum = (vx.dot(F.col("total"), F.col("total")) - F.col("squares")) / 2.0
    pairs = F.col("n") * (F.col("n") - 1) / 2.0
    mean = F.try_divide(pair_sum / (1.0 + COSINE_GUARD), F.nullif(pairs, F.lit(0.0)))
    status = F.when(mean < COHESION_LOW, "LOW").otherwise("ok")
    return sums.select(*_result("cohesion", F.col("construct"), mean, status))


def separation_check(centroid_table: DataFrame, constructs: Sequence[str]) -> DataFrame:
    """Cosine of every two configured constructs' centroids; too close is flagged.

    The pairs to compare come from the settings; centroids join them by name.
    """
    spark = centroid_table.sparkSession
    pairs = spark.createDataFrame(
        list(itertools.combinations(sorted(constructs), 2)), "first string, second string"
    )
    left = centroid_table.select(F.col("construct").alias("first"), F.col("centroid").alias("a"))
    right = centroid_table.select(F.col("construct").alias("second"), F.col("centroid").alias("b"))
    joined = pairs.join(left, "first").join(right, "second")
    likeness = vx.cosine(F.col("a"), F.col("b"))
    status = F.when(likeness > SEPARATION_HIGH, "HIGH OVERLAP").otherwise("ok")
    subject = F.concat_ws(" / ", "first", "second")
    return joined.select(*_result("separation", subject, likeness, status))


def variance_check(ad_features: DataFrame) -> DataFrame:
    """Standard deviation across ads of every construct's mean score."""
    columns = [c for c in ad_features.columns if c.startswith("anchor_") and c.endswith("_mean")]
    if not columns:
        raise ValueError("no anchor mean columns to check")
    spread = ad_features.agg(*[F.stddev_samp(c).alias(c) for c in columns])
    long = spread.unpivot([], columns, "subject", "spread")
    status = F.when(F.col("spread") < VARIANCE_FLAT, "FLAT").otherwise("ok")
    return long.select(*_result("variance", F.col("subject"), F.col("spread"), status))
