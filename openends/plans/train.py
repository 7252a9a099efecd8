"""Train run: predict, then models, drivers and the learning curve."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from openends.config import Study
from openends.operators import curve, drivers, quality, rollup, segments, topics, training
from openends.operators.encode import EncoderSettings, embed_segments
from openends.plans.predict import (
    PredictResult,
    built_in_encoder,
    predict,
    scored_segments,
    share_topics,
)
from openends.sources import responses as response_tables
from openends.sources.shared import cut_lineage

log = logging.getLogger("openends")


@dataclass(frozen=True)
class TrainRun:
    """Fold scores, their summary and top drivers per task, and the learning curve."""

    prediction: PredictResult
    scores: DataFrame | None
    drivers: dict[str, DataFrame] = field(default_factory=dict)
    learning_curve: DataFrame | None = None
    report: DataFrame | None = None


def curve_features(
    responses: DataFrame,
    study: Study,
    encoder: EncoderSettings | None = None,
    cache_path: str | None = None,
    topic_of: DataFrame | None = None,
) -> DataFrame:
    """Ad features of all (n_per_ad, repeat) cells in one plan.

    A sampled segment is encoded and scored once, whatever the number of cells it
    is in. Copies are then flagged within each cell, as a study of that size would
    have flagged them. `topic_of` (segment_id, row_seq, topic_id) adds the topic
    shares within each cell, for topics found on all answers.
    """
    encoder = encoder or built_in_encoder(study)
    grid, cell = study.conversations_grid, curve.CELL
    sample = cut_lineage(
        curve.sampled_responses(responses, grid, study.n_repeats, study.seed)
    )
    chosen = curve.sampled_once(responses, sample)
    # Texts are read once here; the cells, some twenty copies of a row, get digests only.
    prepared = cut_lineage(
        quality.with_digests(segments.build_segments(chosen, study.themes)).drop("norm_text")
    )
    long = prepared.filter("text != ''").select("segment_id", *segments.ROW_COLUMNS, "theme", "text")
    scored = scored_segments(
        embed_segments(long, encoder, cache_path), study, encoder, cache_path
    )
    keys = ["segment_id", "row_seq"]
    # Rows that repeat share their keys, and so their scores.
    scores = cut_lineage(
        scored.select(*keys, *rollup.score_columns(scored)).dropDuplicates(keys)
    )
    flagged = quality.flag_copies(
        curve.with_cells(prepared.drop("text"), sample, grid),
        study.min_tokens,
        study.near_duplicate_min_len,
        within=cell,
    )
    rows = segments.scoreable(flagged).join(scores, keys)
    ads = rollup.ad_features(rollup.respondent_features(rows, within=cell), within=cell)
    if topic_of is None:
        return ads
    topical = rows.select(*cell, *keys, "ad_id").join(
        topic_of.select(*keys, "topic_id").dropDuplicates(keys), keys
    )
    wide = topics.topic_shares_wide(
        topics.topic_shares(topical, cell), share_topics(topic_of, study), cell
    )
    return rollup.with_topic_shares(ads, wide, cell)


def train_run(
    raw: DataFrame,
    labels: DataFrame,
    study: Study,
    encoder: EncoderSettings | None = None,
    cache_path: str | None = None,
    with_curve: bool = True,
    row_order: str | None = None,
    replies: DataFrame | None = None,
) -> TrainRun:
    """Predict, then train every task the labels allow.

    A task the data cannot support is skipped with a warning, and a learning curve
    that fails leaves the models.
    """
    prediction = predict(raw, study, encoder, cache_path, row_order, replies)
    features = cut_lineage(prediction.ad_features)
    dropped = training.unlabelled_ads(features, labels).count()
    if dropped:
        log.warning("%d ad(s) have no label and are left out of training", dropped)
    spark = raw.sparkSession
    tasks = ["3class", "binary"] + (["regression"] if "score" in labels.columns else [])
    scores, summary, top = None, [], {}
    for task in tasks:
        try:
            result = training.train(
                features, labels, task, study.model_name, study.n_splits, study.seed,
                study.n_trees,
            )
        except ValueError as error:
            log.warning("task %s skipped: %s", task, error)
            continue
        table = training.fold_table(spark, result)
        scores = table if scores is None else scores.unionByName(table)
        summary.append(result)
        if task != "regression":
            top[task] = drivers.top_drivers(drivers.permutation_importance(result, study.seed))
    learned = None
    if with_curve:
        try:
            learned = _curve(raw, labels, study, encoder, cache_path, row_order, prediction)
        except Exception:
            log.exception("no learning curve; the models stand")
    report = training.report_table(spark, summary) if summary else None
    return TrainRun(prediction, scores, top, learned, report)


def _curve(
    raw: DataFrame,
    labels: DataFrame,
    study: Study,
    encoder: EncoderSettings | None,
    cache_path: str | None,
    row_order: str | None,
    prediction: PredictResult,
) -> DataFrame:
    responses = response_tables.load_responses(raw, study.themes, row_order)
    cells = cut_lineage(curve_features(responses, study, encoder, cache_path, prediction.topics))
    return curve.learning_curve(
        cells, labels, study.conversations_grid, study.n_repeats,
        model_name=study.model_name, n_splits=study.n_splits, seed=study.seed,
        n_trees=study.n_trees,
    )
