"""Compare anchor scores with the scores a judge gave to the same segments.

Replies arrive as a table (segment_id, construct, raw). This is a check of the
scores and feeds no feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openends.operators.lookup import attach_lookup
from openends.operators.ranks import average_ranks
from openends.sources.shared import cut_lineage


def parse_reply(raw: Column) -> Column:
    """Score in the first-to-last-brace part of a reply; NULL if there is none."""
    body = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    score = F.get_json_object(body, "$.score").try_cast("double")
    return F.nanvl(score, F.lit(None).cast("double"))


def judged_segments(
    segments: DataFrame | None,
    scores: DataFrame,
    replies: DataFrame,
    constructs: Sequence[str],
) -> DataFrame:
    """Segments with text, their anchor score and the judge's score, where both exist.

    Without `segments` all scored segments are taken to have text.
    """
    known = [c for c in scores.columns if c.startswith("anchor_")]
    unknown = [c for c in constructs if f"anchor_{c}" not in known]
    if unknown:
        raise ValueError(f"no anchor scores for construct(s) {unknown}")
    long = scores.select("segment_id", *[f"anchor_{c}" for c in constructs]).unpivot(
        ["segment_id"], [f"anchor_{c}" for c in constructs], "column", "anchor_score"
    )
    named = long.select(
        "segment_id", F.expr("substring(column, length('anchor_') + 1)").alias("construct"), "anchor_score"
    )
    if segments is not None:
        with_text = segments.filter(F.length("text") > 0).select("segment_id")
        named = named.join(with_text, "segment_id")
    judged = replies.select(
        "segment_id", "construct", parse_reply(F.col("raw")).alias("judge_score")
    )
    both = F.col("anchor_score").isNotNull() & F.col("judge_score").isNotNull()
    return named.join(judged, ["segment_id", "construct"]).filter(both)


def safe_corr(left: str, right: str) -> Column:
    """Pearson correlation; NULL when a side is constant or has under two rows.

    Written with moments because the built-in `corr` raises on a constant column
    in ANSI mode.
    """
    spread = F.stddev_pop(left) * F.stddev_pop(right)
    return F.when(spread > 0, F.try_divide(F.covar_pop(left, right), spread))


def judge_correlation(judged: DataFrame) -> DataFrame:
    """Rows, Pearson and Spearman correlation per construct.

    Ranking reads the scores several times, so they are materialised first. Ranks
    come back by a join that spreads frequent scores.
    """
    judged = cut_lineage(judged.select("construct", "segment_id", "anchor_score", "judge_score"))
    ranked, row_hash = judged, F.xxhash64("segment_id")
    for value, rank in (("anchor_score", "anchor_rank"), ("judge_score", "judge_rank")):
        ranks = average_ranks(judged, "construct", value, rank)
        ranked = attach_lookup(ranked, ranks, ["construct", value], row_hash, "inner")
    return ranked.groupBy("construct").agg(
        F.count(F.lit(1)).alias("n"),
        safe_corr("anchor_score", "judge_score").alias("pearson_r"),
        safe_corr("anchor_rank", "judge_rank").alias("spearman_r"),
    )
