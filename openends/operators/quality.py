"""Quality gate: flag empty, short and copied answers, and set them aside.

Flagged rows stay in the table; later steps skip them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openends.functions import text as tx
from openends.operators.lookup import ROWS_PER_SLICE, attach_lookup
from openends.sources.shared import cut_lineage

FLAGS = [
    "flag_empty",
    "flag_too_short",
    "flag_duplicate_verbatim",
    "flag_near_identical_cross_respondent",
]


def text_features(segments: DataFrame) -> DataFrame:
    """Add the word count and the form of the text used to find copies."""
    return segments.withColumns(
        {
            "norm_text": tx.match_text(F.col("text")),
            "token_count": tx.token_count(F.col("text")).cast("int"),
        }
    )


def with_digests(segments: DataFrame) -> DataFrame:
    """Segments with all that the gate asks of their texts: word count, norm_text, its digest and length.

    This is the costly part of the gate. Rows that take part more than once, as in
    resampling cells, get it once and are then flagged by `flag_copies` without their texts.
    """
    # The coalesce and the filter state what the joins of the gate need: no key is NULL.
    digest = F.coalesce(tx.digest(F.col("norm_text")), F.lit(b""))
    return text_features(segments).withColumns(
        {
            "_digest": digest,
            "_norm_len": F.length("norm_text"),
            "flag_empty": F.length("text") == 0,
        }
    )


def quality_gate(
    segments: DataFrame,
    min_tokens: int = 4,
    near_duplicate_min_len: int = 20,
    distinct_respondents: bool = False,
    within: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
    materialise: bool = False,
) -> DataFrame:
    """Add norm_text, token_count, the four flags and `quarantined`.

    Copies are counted per theme, text digest, respondent and ad with map-side combining.
    Both checks are answered on those counts, which hold no text, and only the keys that
    are flagged are joined back, in one join; hot keys are cut into slices and rows that no check can
    flag, such as blanks, are dealt out evenly. A text moves once at most, and not at all
    where only the flags are asked for.

    `distinct_respondents` counts respondents instead of rows in the
    cross-respondent check. `within` keeps resampling cells apart. `materialise`
    writes the texts with their digests to the shared folder before they are counted
    and flagged, so cleaning and normalising, the costly part, run once.
    """
    rows = with_digests(segments)
    if materialise:
        # norm_text is as long as the text, so it is redone, if asked for, not stored.
        rows = cut_lineage(rows.drop("norm_text"))
        rows = rows.withColumn("norm_text", tx.match_text(F.col("text")))
    flagged = flag_copies(
        rows, min_tokens, near_duplicate_min_len, distinct_respondents, within, rows_per_slice
    )
    return flagged.select(
        *segments.columns, "norm_text", "token_count", *FLAGS, "quarantined"
    )


def quality_flags(segments: DataFrame, **options) -> DataFrame:
    """The gate for callers that want no texts: every column but `text`, token_count, the four flags and `quarantined`.

    Each text is normalised once: its digest, length and word count are stored in the shared
    folder, and both reads of the copy checks are of those narrow rows. `options` are those of `flag_copies`.
    """
    rows = cut_lineage(with_digests(segments).drop("text", "norm_text"))
    kept = [c for c in segments.columns if c != "text"]
    return flag_copies(rows, **options).select(*kept, "token_count", *FLAGS, "quarantined")


def flag_copies(
    rows: DataFrame,
    min_tokens: int = 4,
    near_duplicate_min_len: int = 20,
    distinct_respondents: bool = False,
    within: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rows of `with_digests` with the four flags and `quarantined`; texts are not looked at."""
    within = list(within)
    rows = rows.withColumn(
        "flag_too_short", ~F.col("flag_empty") & (F.col("token_count") < min_tokens)
    )
    text_key = [*within, "theme", "_digest"]
    row_key = [*text_key, "respondent_id", "ad_id"]
    keyed = rows.filter("theme IS NOT NULL AND respondent_id IS NOT NULL AND ad_id IS NOT NULL")
    counted = keyed.filter("_norm_len > 0").groupBy(*row_key).agg(
        F.count(F.lit(1)).alias("n"), F.max("_norm_len").alias("norm_len")
    )

    def repeated(by: str, min_len: int, repeats: Column, mark: str) -> DataFrame:
        # Both checks ask for the same columns of the counts, and so read one shuffle.
        totals = counted.groupBy(*text_key, by).agg(
            F.count(F.lit(1)).alias("n_rows"),
            repeats.alias("n_repeats"),
            F.max("norm_len").alias("norm_len"),
        )
        found = totals.filter((F.col("n_repeats") > 1) & (F.col("norm_len") >= min_len))
        return found.select(*text_key, by, "n_rows", F.lit(True).alias(mark))

    long = F.col("norm_len") >= near_duplicate_min_len
    same_respondent = repeated("respondent_id", 1, F.sum("n"), "_same_respondent")
    repeats = F.count(F.lit(1)) if distinct_respondents else F.sum("n")
    same_ad = repeated("ad_id", near_duplicate_min_len, repeats, "_same_ad")
    key_hash = F.xxhash64(*row_key)
    marked = attach_lookup(
        counted,
        same_respondent,
        [*text_key, "respondent_id"],
        key_hash,
        rows_per_slice=rows_per_slice,
    )
    marked = attach_lookup(
        marked,
        same_ad,
        [*text_key, "ad_id"],
        key_hash,
        rows_per_slice=rows_per_slice,
        may_match=long,
    )
    copies = marked.filter("_same_respondent OR _same_ad").select(
        *row_key, F.col("n").alias("n_rows"), "_same_respondent", "_same_ad"
    )
    flagged = attach_lookup(
        rows,
        copies,
        row_key,
        F.xxhash64("segment_id", "row_seq"),
        rows_per_slice=rows_per_slice,
        may_match=F.col("_norm_len") > 0,
    ).withColumns(
        {
            "flag_duplicate_verbatim": F.col("_same_respondent").isNotNull(),
            "flag_near_identical_cross_respondent": ~F.col("flag_empty")
            & F.col("_same_ad").isNotNull(),
        }
    )
    any_flag = F.col(FLAGS[0])
    for flag in FLAGS[1:]:
        any_flag = any_flag | F.col(flag)
    return flagged.withColumn("quarantined", any_flag)


def quality_report(flagged: DataFrame) -> DataFrame:
    """Flag counts, segments and quarantine rate per theme."""
    counts = [F.count_if(F.col(c)).alias(c) for c in [*FLAGS, "quarantined"]]
    report = flagged.groupBy("theme").agg(*counts, F.count(F.lit(1)).alias("n_segments"))
    return report.withColumn(
        "quarantine_rate", F.bround(F.col("quarantined") / F.col("n_segments"), 3)
    )


def quality_totals(flagged: DataFrame) -> DataFrame:
    """Quarantined segments overall, as a count and in percent."""
    totals = flagged.agg(
        F.count_if(F.col("quarantined")).alias("n_quarantined"),
        F.count(F.lit(1)).alias("n_segments"),
    )
    share = F.col("n_quarantined") / F.greatest(F.col("n_segments"), F.lit(1))
    return totals.withColumn("quarantined_pct", 100.0 * share)
