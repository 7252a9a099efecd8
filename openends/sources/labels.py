"""Ad labels: a band per ad and, if known, a score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends.errors import ContractError

# The only bands a label may have.
BANDS = ["Strong", "Average", "Weak"]


def unknown_bands(labels: DataFrame) -> DataFrame:
    """Distinct band values outside the domain; a missing band is allowed."""
    return labels.filter(F.col("band").isNotNull() & ~F.col("band").isin(BANDS)).select(
        "band"
    ).distinct()


def repeated_ads(labels: DataFrame) -> DataFrame:
    """Ads with more than one label."""
    return (
        labels.groupBy("ad_id").agg(F.count(F.lit(1)).alias("n_labels")).filter("n_labels > 1")
    )


def label_columns(
    raw: DataFrame, ad_id_col: str = "Ad ID", band_col: str = "band", score_col: str | None = None
) -> DataFrame:
    """ad_id, band and, where the column exists, score; other columns are left."""
    missing = [c for c in (ad_id_col, band_col) if c not in raw.columns]
    if missing:
        raise ContractError(f"labels lack required column(s) {missing}")
    columns = [
        F.trim(F.col(f"`{ad_id_col}`").cast("string")).alias("ad_id"),
        F.col(f"`{band_col}`").cast("string").alias("band"),
    ]
    if score_col and score_col in raw.columns:
        columns.append(F.col(f"`{score_col}`").try_cast("double").alias("score"))
    return raw.select(*columns)


def load_labels(
    raw: DataFrame, ad_id_col: str = "Ad ID", band_col: str = "band", score_col: str | None = None
) -> DataFrame:
    """Checked labels; raises on an unknown band or an ad labelled twice."""
    labels = label_columns(raw, ad_id_col, band_col, score_col)
    bad = [r.band for r in unknown_bands(labels).limit(10).collect()]
    if bad:
        raise ContractError(f"unexpected band value(s) {sorted(bad)}; expected {BANDS}")
    twice = [r.ad_id for r in repeated_ads(labels).limit(5).collect()]
    if twice:
        raise ContractError(f"ads with more than one label, e.g. {twice}")
    return labels
