"""Predict run: responses to features, quality report, topics and judge check."""

from __future__ import annotations

import functools
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openends.config import Study, active_themes
from openends.functions import text as tx
from openends.operators import anchors, density, judge, quality, ranks, rollup, segments, topics
from openends.operators.encode import EncoderSettings, embed_segments
from openends.plans.counts import counted
from openends.sources import responses as response_tables
from openends.sources.shared import cut_lineage

log = logging.getLogger("openends")

SCORED_COLUMNS = ["segment_id", *segments.ROW_COLUMNS, "theme", "quarantined"]


@dataclass(frozen=True)
class PredictResult:
    """Tables of a predict run; the optional ones depend on the study."""

    segments: DataFrame
    quality_report: DataFrame
    scored: DataFrame
    respondent_features: DataFrame
    ad_features: DataFrame
    topics: DataFrame | None = None
    topic_labels: DataFrame | None = None
    judge_report: DataFrame | None = None
    topic_shares: DataFrame | None = None
    counts: DataFrame | None = None


def built_in_encoder(study: Study) -> EncoderSettings:
    """Hashed tokens; needs no model and no network."""
    return EncoderSettings(study.encoder_name, study.output_dim)


def study_centroids(
    spark: SparkSession, study: Study, encoder: EncoderSettings, cache_path: str | None = None
) -> DataFrame:
    """Centroids of the study's constructs; phrases are encoded, and cached, like answers."""
    phrases = anchors.anchor_table(spark, study.anchor_sets()).withColumns(
        {"segment_id": F.col("construct"), "row_seq": F.lit(0).cast("bigint")}
    )
    vectors = embed_segments(phrases, encoder, cache_path)
    return anchors.centroids(vectors.select("construct", "theme", "vector"))


def flagged_segments(
    responses: DataFrame, study: Study, within: Sequence[str] = (), materialise: bool = False
) -> DataFrame:
    """Segments of the study's themes with quality flags."""
    long = segments.build_segments(responses, study.themes, within)
    return quality.quality_gate(
        long,
        study.min_tokens,
        study.near_duplicate_min_len,
        within=within,
        materialise=materialise,
    )


def scored_segments(
    embedded: DataFrame, study: Study, encoder: EncoderSettings, cache_path: str | None = None
) -> DataFrame:
    """Scores on [0, 1], or on the calibrated range, for segments with vectors."""
    names = anchors.construct_names(study.anchor_sets())
    table = study_centroids(embedded.sparkSession, study, encoder, cache_path)
    centroids = anchors.collect_centroids(table, names)
    scored = anchors.score_wide_arrow(embedded, centroids, names)
    return anchors.calibrate_scores(scored, [f"anchor_{n}" for n in names], study.calibration)


def discover(embedded: DataFrame, study: Study, dim: int) -> DataFrame:
    """Topic per scoreable segment, with its text for the labels; vectors have `dim` numbers.

    The fits read the vectors only; k-means keeps its own reduced copy meanwhile.
    """
    if study.topic_method == "kmeans":
        points = topics.reduce_pca(embedded, study.reduced_dim).drop("vector")
        assigned = topics.kmeans_topics(points, study.topics, study.min_cluster_size, study.seed)
    else:
        if study.density_dim is None:
            points = embedded.withColumn("coords", F.col("vector").cast("array<double>"))
        else:
            dim = study.density_dim
            points = topics.reduce_pca(embedded, dim)
        assigned = density.projected_topics(
            points.drop("vector"),
            dim,
            study.density_radius,
            study.density_min_points,
            study.min_cluster_size,
            seed=study.seed,
        )
    return assigned.select("segment_id", "row_seq", "ad_id", "topic_id", "text")


def share_topics(assigned: DataFrame, study: Study) -> list[int]:
    """Topics whose shares become feature columns."""
    return topics.topic_ids(
        assigned, study.share_columns if study.topic_method == "density" else None
    )


def judge_report(scored: DataFrame, replies: DataFrame, study: Study) -> DataFrame:
    """Correlation with the judge on all replies, or on a seeded sample per construct if asked for."""
    names = list(study.judge_constructs)
    judged = judge.judged_segments(None, scored, replies, names)
    if study.judge_sample_size is not None:
        judged = ranks.sample_per_group(
            judged, ["construct"], ["segment_id"], study.judge_sample_size, study.seed
        )
    return judge.judge_correlation(judged)


def predict(
    raw: DataFrame,
    study: Study,
    encoder: EncoderSettings | None = None,
    cache_path: str | None = None,
    row_order: str | None = None,
    replies: DataFrame | None = None,
) -> PredictResult:
    """Run the study on a raw response table.

    Settings are checked before any data is read; an order that is not a number stops the first
    write, and only then are its respondents looked up. What is read more than once is
    materialised in the shared folder: the flagged segments, the vectors if topics
    need them, and the scores without texts. With a cache path no text, answer or phrase, is
    encoded twice, nor again in a later run.
    """
    study.calibration.check()
    study.check_topics()
    themes = active_themes(study.themes)
    encoder = encoder or built_in_encoder(study)
    response_tables.check_columns(raw.columns, study.themes)
    responses = response_tables.load_responses(raw, study.themes, row_order)
    try:
        flagged = flagged_segments(responses, study, materialise=True).drop("norm_text")
        flagged = cut_lineage(flagged)
    except Exception:
        response_tables.check_order(raw)
        raise
    usable = segments.scoreable(flagged).select(*SCORED_COLUMNS, "text")
    embedded = embed_segments(usable, encoder, cache_path)
    if study.run_discovery:
        single = F.col("vector").cast("array<float>")
        embedded = cut_lineage(embedded.withColumn("vector", single))
    scored = scored_segments(embedded.drop("text"), study, encoder, cache_path)
    scored = cut_lineage(scored)
    _warn_unscored(scored)

    # Quarantined segments have no score; they only count when asked for.
    rows = scored if study.exclude_quarantined else _with_quarantined(scored, flagged)
    conversations = rollup.respondent_features(rows, study.exclude_quarantined)
    ads = rollup.ad_features(conversations)
    assigned = labels = shares = None
    counts = [
        counted(*response_tables.key_counters(raw, study.themes)),
        _segment_counts(flagged, list(themes)),
        _key_counts(flagged),
    ]
    if rollup.score_columns(scored):
        counts.append(_score_counts(scored))
    if study.run_discovery and embedded.isEmpty():
        log.warning("no segment passed the quality gate; no topics to find")
    elif study.run_discovery:
        with_text = discover(embedded, study, encoder.dim)
        labels = topics.topic_labels(topics.topic_terms(with_text))
        assigned = cut_lineage(with_text.drop("text"))
        shares = topics.topic_shares(assigned)
        ids = share_topics(assigned, study)
        ads = rollup.with_topic_shares(ads, topics.topic_shares_wide(shares, ids))
        counts.append(_topic_counts(assigned))
    return PredictResult(
        segments=flagged.withColumn("norm_text", tx.match_text(F.col("text"))),
        quality_report=quality.quality_report(flagged),
        scored=scored,
        respondent_features=conversations,
        ad_features=ads,
        topics=assigned,
        topic_labels=labels,
        judge_report=None if replies is None else judge_report(scored, replies, study),
        topic_shares=shares,
        counts=functools.reduce(DataFrame.unionByName, counts),
    )


def _segment_counts(flagged: DataFrame, themes: Sequence[str]) -> DataFrame:
    """Segments, flags, and segments to score per theme."""
    usable = ~F.col("quarantined")
    return counted(
        flagged,
        {("quality", "segments"): F.count(F.lit(1))}
        | {("quality", c): F.count_if(F.col(c)) for c in [*quality.FLAGS, "quarantined"]}
        | {("scoreable", t): F.count_if(usable & (F.col("theme") == t)) for t in themes},
    )


def _key_counts(flagged: DataFrame) -> DataFrame:
    """Respondents, ads, and ads without a segment to score, from one roll-up of pairs."""
    pairs = flagged.groupBy("respondent_id", "ad_id").agg(
        F.max(~F.col("quarantined")).alias("usable")
    )
    usable_ad = F.when(F.col("usable"), F.col("ad_id"))
    lost = F.count_distinct("ad_id") - F.count_distinct(usable_ad)
    return counted(
        pairs,
        {
            ("responses", "respondents"): F.count_distinct("respondent_id"),
            ("responses", "ads"): F.count_distinct("ad_id"),
            ("quality", "fully_quarantined_ads"): lost,
        },
    )


def _score_counts(scored: DataFrame) -> DataFrame:
    columns = rollup.score_columns(scored)
    return counted(scored, {("scores", c): F.count(F.col(c)) for c in columns})


def _topic_counts(assigned: DataFrame) -> DataFrame:
    summary = topics.topic_summary(assigned)
    return counted(summary, {("topics", c): F.max(c) for c in summary.columns})


def _warn_unscored(scored: DataFrame) -> None:
    """Name the constructs without any score; one row per construct comes back."""
    if not rollup.score_columns(scored):
        log.warning("no construct is active; features hold no scores")
        return
    for row in rollup.construct_coverage(scored).filter("all_missing").collect():
        log.warning("%s has no score in any segment", row.score_column)


def _with_quarantined(scored: DataFrame, flagged: DataFrame) -> DataFrame:
    rest = flagged.filter(F.col("quarantined")).select(*SCORED_COLUMNS)
    return scored.unionByName(rest, allowMissingColumns=True)
