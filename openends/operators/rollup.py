"""Roll scored segments up to respondent and ad level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends.operators.segments import scoreable


def score_columns(table: DataFrame) -> list[str]:
    """Score columns in table order."""
    return [c for c in table.columns if c.startswith("anchor_")]


def respondent_features(
    scored: DataFrame, exclude_quarantined: bool = True, within: Sequence[str] = ()
) -> DataFrame:
    """One row per respondent and ad with one score per construct.

    A construct is scored on one theme, so the mean over a conversation's themes
    just recovers that one score. Metadata comes from the conversation's first
    row. All of it is one aggregate with map-side combining; a plan that does not
    ask for the text columns aggregates numbers only.
    """
    rows = scoreable(scored) if exclude_quarantined else scored
    return rows.groupBy(*within, "respondent_id", "ad_id").agg(
        *[F.avg(c).alias(c) for c in score_columns(scored)],
        F.count(F.lit(1)).alias("n_themes_scored"),
        *[F.min_by(c, "row_seq").alias(c) for c in ("order_shown", "brand", "platform")],
    )


def ad_features(conversations: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """One row per ad: mean and sample std per construct and of the order shown.

    Input is `respondent_features`, so every conversation counts once.
    """
    stats = []
    for column in score_columns(conversations):
        stats += [
            F.avg(column).alias(f"{column}_mean"),
            F.stddev_samp(column).alias(f"{column}_std"),
        ]
    return conversations.groupBy(*within, "ad_id").agg(
        *stats,
        F.avg("order_shown").alias("order_shown_mean"),
        F.stddev_samp("order_shown").alias("order_shown_std"),
        F.count(F.lit(1)).alias("n_conversations"),
    )


def with_topic_shares(
    ads: DataFrame, shares_wide: DataFrame, within: Sequence[str] = ()
) -> DataFrame:
    """Add topic shares; an ad without topics keeps NULL shares."""
    return ads.join(shares_wide, [*within, "ad_id"], "left")


def construct_scores(scores_long: DataFrame) -> DataFrame:
    """Mean, std and count per ad and construct from a long score table."""
    return scores_long.groupBy("ad_id", "construct").agg(
        F.avg("score").alias("score_mean"),
        F.stddev_samp("score").alias("score_std"),
        F.count("score").alias("n_scores"),
    )


def fully_quarantined_ads(flagged: DataFrame) -> DataFrame:
    """Ads that vanish from the features because no segment passed the gate."""
    return (
        flagged.groupBy("ad_id")
        .agg(
            F.count(F.lit(1)).alias("n_segments"),
            F.count_if(~F.col("quarantined")).alias("n_scoreable"),
        )
        .filter(F.col("n_scoreable") == 0)
        .select("ad_id", "n_segments")
    )


def construct_coverage(scored: DataFrame) -> DataFrame:
    """How many scoreable segments each construct scored; 0 points to a broken run."""
    columns = score_columns(scored)
    if not columns:
        raise ValueError("no anchor score columns to check")
    counts = scoreable(scored).agg(*[F.count(c).alias(c) for c in columns])
    return counts.unpivot([], columns, "score_column", "n_scored").withColumn(
        "all_missing", F.col("n_scored") == 0
    )
