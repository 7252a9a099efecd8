"""All vector, anchor and score checks in one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from openends.operators import anchors, checks


def diagnostics(
    phrase_vectors: DataFrame,
    constructs: Sequence[str],
    probes: DataFrame | None = None,
    ad_features: DataFrame | None = None,
) -> DataFrame:
    """(check, subject, value, status); the last two inputs are optional."""
    table = checks.norm_check(phrase_vectors)
    if probes is not None:
        table = table.unionByName(checks.pair_check(probes))
    table = table.unionByName(checks.cohesion_check(phrase_vectors))
    centroid_table = anchors.centroids(phrase_vectors)
    table = table.unionByName(checks.separation_check(centroid_table, constructs))
    if ad_features is not None:
        table = table.unionByName(checks.variance_check(ad_features))
    return table
