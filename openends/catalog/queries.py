"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openends.catalog import tables as t
from openends.config import Calibration
from openends.functions import text as tx
from openends.functions import vectors as vx
from openends.operators import (
    anchors,
    checks,
    curve,
    density,
    drivers,
    encode,
    judge,
    quality,
    ranks,
    rollup,
    segments,
    topics,
    training,
)
from openends.plans import diagnostics as diagnostic_plan
from openends.plans import predict as predict_plan
from openends.plans import train as train_plan
from openends.sources import cache, labels, outputs, responses, shared

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STUDY = t.STUDY
NAMES = anchors.construct_names(STUDY.anchor_sets())
ENCODER = predict_plan.built_in_encoder(STUDY)
TEXTS = ["memory", "meaning", "emotion", "improvement", "reason"]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def r6(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("double"), 6)


def rounded(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Round the double columns; ranks, counts and keys stay as they are."""
    names = columns or [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: r6(c) for c in names})


def big(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# --- responses -----------------------------------------------------------------


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.load_responses(t.raw_responses(spark, sf_dir), STUDY.themes)


def long_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.build_segments(cleaned(spark, sf_dir), STUDY.themes)


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_plan.flagged_segments(cleaned(spark, sf_dir), STUDY, materialise=True)


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.embed_segments(segments.scoreable(flagged(spark, sf_dir)), ENCODER)


def centroid_table(spark: SparkSession) -> DataFrame:
    return predict_plan.study_centroids(spark, STUDY, ENCODER)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.score_wide(embedded(spark, sf_dir), centroid_table(spark), NAMES)


@query
def response_contract(spark, sf_dir):
    df = cleaned(spark, sf_dir).drop("row_seq")
    named = df.withColumnsRenamed(dict(zip(t.ANSWERS, TEXTS, strict=True)))
    return big(named, "order_shown")


@query
def response_counts(spark, sf_dir):
    return responses.response_counts(cleaned(spark, sf_dir))


@query
def blank_keys(spark, sf_dir):
    return responses.blank_key_count(t.raw_responses(spark, sf_dir), STUDY.themes)


@query
def repeated_pairs(spark, sf_dir):
    docs = t.document_segments(spark, sf_dir)
    return responses.repeated_pairs(docs.select("respondent_id", "ad_id"))


@query
def append_responses(spark, sf_dir):
    raw = t.raw_responses(spark, sf_dir)
    late = F.col("Order Shown").startswith(" 2")
    both = responses.combine_responses(raw.filter(~late), raw.filter(late), STUDY.themes)
    return both.groupBy(F.trim("Order Shown").alias("order_text")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("Respondent ID").alias("n_respondents")
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, which all executors share."""
    return f"{shared.checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def append_round_trip(spark, sf_dir):
    raw, path = t.raw_responses(spark, sf_dir), scratch(spark, "responses")
    late = F.col("Order Shown").startswith(" 2")
    responses.append_responses(raw.filter(~late), path, STUDY.themes)
    responses.append_responses(raw.filter(late), path, STUDY.themes)
    stored = responses.load_responses(responses.read_table(spark, path), STUDY.themes)
    return stored.groupBy("order_shown").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("respondent_id").alias("n_respondents")
    ).transform(big, "order_shown")


@query
def segments_long(spark, sf_dir):
    df = long_segments(spark, sf_dir)
    return big(df.drop("row_seq"), "order_shown")


# --- quality -------------------------------------------------------------------


@query
def token_count_norm_text(spark, sf_dir):
    df = quality.text_features(t.document_segments(spark, sf_dir))
    return big(df.select("doc_id", "token_count", "norm_text"), "token_count")


def document_flags(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Flags of documents, without texts."""
    return quality.quality_flags(t.document_segments(spark, sf_dir), **options)


@query
def qc_flags(spark, sf_dir):
    df = document_flags(spark, sf_dir)
    return df.select("doc_id", "theme", *quality.FLAGS, "quarantined")


@query
def qc_flags_distinct_respondents(spark, sf_dir):
    df = document_flags(spark, sf_dir, distinct_respondents=True)
    return df.select("doc_id", "flag_near_identical_cross_respondent", "quarantined")


@query
def qc_flags_responses(spark, sf_dir):
    df = flagged(spark, sf_dir)
    return big(df.select("segment_id", "token_count", *quality.FLAGS, "quarantined"), "token_count")


@query
def qc_report(spark, sf_dir):
    return quality.quality_report(document_flags(spark, sf_dir))


@query
def qc_totals(spark, sf_dir):
    return rounded(quality.quality_totals(document_flags(spark, sf_dir)))


@query
def quarantine_free_segments(spark, sf_dir):
    # Texts are asked for, so they are stored with their digests and move once.
    df = quality.quality_gate(t.document_segments(spark, sf_dir), materialise=True)
    return segments.scoreable(df).select("doc_id", "theme", "text")


@query
def ads_fully_quarantined(spark, sf_dir):
    df = document_flags(spark, sf_dir, min_tokens=400)
    return rollup.fully_quarantined_ads(
        df.withColumn("ad_id", F.concat_ws("/", "respondent_id", "ad_id", "theme"))
    )


# --- vectors -------------------------------------------------------------------


def exploded(df: DataFrame, key: str, column: str) -> DataFrame:
    # The outer form: for the inner one Spark adds a filter that asks for a vector
    # that is not empty, and so computes every vector once more.
    return df.select(key, F.posexplode_outer(column).alias("pos", "value")).select(
        key, F.col("pos").cast("bigint").alias("pos"), r6("value").alias("value")
    )


@query
def content_keys(spark, sf_dir):
    text = tx.apply_instruction(F.col("text"), "Find answers like: {text}")
    key = tx.content_key(F.col("text"), "hashed-tokens", 64, "Find answers like: {text}")
    return t.table(spark, sf_dir, "documents").select(
        "doc_id", key.alias("key"), F.md5(text).alias("payload_md5")
    )


@query
def vector_normalize(spark, sf_dir):
    df = t.table(spark, sf_dir, "embeddings").withColumn(
        "vector", F.transform("embedding", lambda x: x.cast("double") * 3 + 0.01)
    )
    return exploded(encode.unit_vectors(df), "vec_id", "vector")


@query
def vector_truncate(spark, sf_dir):
    df = t.table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    return exploded(encode.truncated_vectors(df, 16), "vec_id", "vector")


@query
def vector_dimension_check(spark, sf_dir):
    df = t.table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    return big(encode.check_dimension(df, 64), "shortest", "longest")


@query
def hashed_encoder(spark, sf_dir):
    df = t.table(spark, sf_dir, "documents").select(
        "doc_id", vx.hashed_vector(F.col("text"), 64).alias("vector")
    )
    return exploded(df, "doc_id", "vector").filter("value != 0")


def document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.distinct_texts(t.table(spark, sf_dir, "documents").select("text"), ENCODER)


def benchmark_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the texts of conversations and repeated documents, as a cache."""
    turns = t.table(spark, sf_dir, "conversations").select("text")
    copies = t.table(spark, sf_dir, "documents").groupBy("text").count().filter("count > 1")
    wanted = encode.distinct_texts(turns.unionByName(copies.select("text")), ENCODER)
    vectors = encode.encode_texts(wanted, ENCODER)
    return vectors.select("key", "vector", F.lit(1).cast("bigint").alias("batch"))


@query
def cache_misses(spark, sf_dir):
    missing = cache.misses(document_keys(spark, sf_dir), benchmark_cache(spark, sf_dir))
    return missing.select("key", F.length("text").cast("bigint").alias("n_chars"))


@query
def cache_counts(spark, sf_dir):
    return cache.hit_counts(document_keys(spark, sf_dir), benchmark_cache(spark, sf_dir))


@query
def cache_upsert(spark, sf_dir):
    vectors = t.table(spark, sf_dir, "embeddings")
    old = vectors.select(
        F.col("vec_id").cast("string").alias("key"),
        F.col("embedding").alias("vector"),
        F.lit(1).cast("bigint").alias("batch"),
    )
    new = vectors.select(
        (F.col("vec_id") + 100).cast("string").alias("key"),
        F.reverse("embedding").alias("vector"),
        F.lit(2).cast("bigint").alias("batch"),
    )
    return exploded(cache.upsert(old, new), "key", "vector")


@query
def cached_embedding(spark, sf_dir):
    rows = segments.scoreable(flagged(spark, sf_dir))
    df = encode.embed_segments(rows, ENCODER, scratch(spark, "vectors"))
    return exploded(df, "segment_id", "vector").filter("value != 0")


# --- anchors and scores --------------------------------------------------------


@query
def construct_centroids(spark, sf_dir):
    return exploded(anchors.centroids(t.label_phrases(spark, sf_dir)), "construct", "centroid")


@query
def anchor_scores_long(spark, sf_dir):
    table = anchors.centroids(t.label_phrases(spark, sf_dir))
    names = list(t.VECTOR_CONSTRUCTS)
    return rounded(anchors.score_long(t.vector_segments(spark, sf_dir), table, names))


def vector_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = anchors.centroids(t.label_phrases(spark, sf_dir))
    return anchors.score_wide(
        t.vector_segments(spark, sf_dir), table, list(t.VECTOR_CONSTRUCTS)
    ).drop("vector")


@query
def anchor_scores_wide(spark, sf_dir):
    df = vector_scores(spark, sf_dir)
    return rounded(df.select("segment_id", *rollup.score_columns(df)))


@query
def anchor_scores_pivot(spark, sf_dir):
    table = anchors.centroids(t.label_phrases(spark, sf_dir))
    names = list(t.VECTOR_CONSTRUCTS)
    long = anchors.score_long(t.vector_segments(spark, sf_dir), table, names)
    return rounded(anchors.long_to_wide(long, names))


@query
def anchor_scores_arrow(spark, sf_dir):
    names = list(t.VECTOR_CONSTRUCTS)
    table = anchors.centroids(t.label_phrases(spark, sf_dir))
    centroids = anchors.collect_centroids(table, names)
    rows = t.vector_segments(spark, sf_dir).select("segment_id", "theme", "vector")
    return rounded(anchors.score_wide_arrow(rows, centroids, names).drop("theme"))


@query
def calibrated_scores(spark, sf_dir):
    df = vector_scores(spark, sf_dir)
    columns = rollup.score_columns(df)
    stretched = anchors.calibrate_scores(df, columns, Calibration(True, 0, 10))
    return rounded(stretched.select("segment_id", *columns))


@query
def attached_scores(spark, sf_dir):
    scores = vector_scores(spark, sf_dir).select("segment_id", "anchor_c1", "anchor_c5")
    kept = scores.filter(F.col("anchor_c1") > 0.5)
    plain = t.vector_segments(spark, sf_dir).select("segment_id", "ad_id")
    return rounded(anchors.attach_scores(plain, kept))


@query
def constructs_without_segments(spark, sf_dir):
    # One construct is mapped to a question that no segment answers.
    unasked = F.when(F.col("construct") == "c9", "Recall").otherwise(F.col("theme"))
    phrases = t.label_phrases(spark, sf_dir).withColumn("theme", unasked)
    return anchors.constructs_without_segments(
        anchors.centroids(phrases), t.document_segments(spark, sf_dir)
    )


@query
def ad_construct_scores(spark, sf_dir):
    long = anchors.score_long(
        embedded(spark, sf_dir), centroid_table(spark), NAMES, ["segment_id", "ad_id"]
    )
    return rounded(rollup.construct_scores(long))


# --- roll-ups ------------------------------------------------------------------


@query
def respondent_features(spark, sf_dir):
    return big(rounded(rollup.respondent_features(scored(spark, sf_dir))), "order_shown")


@query
def ad_features(spark, sf_dir):
    conversations = rollup.respondent_features(scored(spark, sf_dir))
    return rounded(rollup.ad_features(conversations))


@query
def ad_features_with_quarantined(spark, sf_dir):
    rows = scored(spark, sf_dir).unionByName(
        flagged(spark, sf_dir).filter("quarantined"), allowMissingColumns=True
    )
    conversations = rollup.respondent_features(rows, exclude_quarantined=False)
    ads = rollup.ad_features(conversations)
    return rounded(ads.select("ad_id", "order_shown_mean", "order_shown_std", "n_conversations"))


@query
def ad_features_vectors(spark, sf_dir):
    conversations = rollup.respondent_features(vector_scores(spark, sf_dir))
    return rounded(rollup.ad_features(conversations))


@query
def order_shown_stats(spark, sf_dir):
    conversations = rollup.respondent_features(segments.scoreable(flagged(spark, sf_dir)))
    ads = rollup.ad_features(conversations)
    return rounded(ads.select("ad_id", "order_shown_mean", "order_shown_std", "n_conversations"))


@query
def first_metadata(spark, sf_dir):
    docs = document_flags(spark, sf_dir).withColumns(
        {
            "order_shown": (F.col("doc_id") % 3 + 1).cast("int"),
            "brand": F.concat(F.lit("b"), F.col("doc_id")),
            "platform": F.concat(F.lit("p"), F.col("doc_id") % 7),
        }
    )
    first = rollup.respondent_features(docs)
    columns = ["respondent_id", "ad_id", "n_themes_scored", "order_shown", "brand", "platform"]
    return big(first.select(*columns), "order_shown")


@query
def construct_coverage(spark, sf_dir):
    return rollup.construct_coverage(scored(spark, sf_dir))


# --- topics --------------------------------------------------------------------


def document_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a given topic per language and theme; junk lengths are noise."""
    docs = t.document_segments(spark, sf_dir)
    topic = F.ascii("ad_id") % 5 * 4 + F.length("text") % 4
    return docs.withColumn("topic_id", F.when(topic % 7 == 0, -1).otherwise(topic))


@query
def topic_shares(spark, sf_dir):
    df = topics.topic_shares(t.vector_segments(spark, sf_dir))
    return rounded(big(df, "topic_id"))


@query
def topic_shares_wide(spark, sf_dir):
    shares = topics.topic_shares(t.vector_segments(spark, sf_dir))
    return rounded(topics.topic_shares_wide(shares, list(range(9))))


@query
def topic_summary(spark, sf_dir):
    return topics.topic_summary(t.vector_segments(spark, sf_dir))


@query
def topic_term_weights(spark, sf_dir):
    weights = topics.topic_terms(document_topics(spark, sf_dir), t.STOP_WORDS)
    return rounded(big(weights, "topic_id"))


@query
def topic_term_weights_5000(spark, sf_dir):
    weights = topics.topic_terms(document_topics(spark, sf_dir), t.STOP_WORDS, max_terms=5000)
    return rounded(big(weights, "topic_id"))


@query
def ctfidf_labels(spark, sf_dir):
    weights = topics.topic_terms(document_topics(spark, sf_dir), t.STOP_WORDS)
    return big(topics.topic_labels(weights), "topic_id")


@query
def topics_density(spark, sf_dir):
    rows = t.vector_segments(spark, sf_dir).drop("topic_id")
    # Three fixed sums of all numbers of a vector, each with signs of its own.
    axes = [F.lit([float(x) for x in t.signs(axis)]) for axis in range(3)]
    coords = F.array(*[F.round(vx.dot(F.col("vector"), signs) / 8, 9) for signs in axes])
    df = topics.density_topics(
        rows.withColumn("coords", coords), dim=3, cell_size=0.06, min_points=3, min_cluster_size=8
    )
    return df.select("segment_id", "ad_id", "topic_id")


@query
def topics_projected(spark, sf_dir):
    """Density topics of documents on all numbers of their vectors."""
    docs = t.document_segments(spark, sf_dir)
    vectors = docs.select(
        "doc_id", "segment_id", vx.hashed_vector(F.col("text"), 64).alias("coords")
    )
    # A text is encoded once.
    df = density.projected_topics(shared.stored(vectors, "vectors"), **t.DENSITY)
    return df.select("doc_id", "topic_id")


def topics_kmeans_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = topics.reduce_pca(t.vector_segments(spark, sf_dir).drop("topic_id"), 5)
    return topics.kmeans_topics(points, k=10, min_cluster_size=8)


@query
def topics_kmeans(spark, sf_dir):
    return topics_kmeans_points(spark, sf_dir).select("segment_id", "ad_id", "topic_id")


# --- judge ---------------------------------------------------------------------


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = t.judge_replies(spark, sf_dir)
    # Only segments with a reply are encoded.
    asked = t.document_segments(spark, sf_dir).join(
        replies.select("segment_id").distinct(), "segment_id", "left_semi"
    )
    docs = encode.embed_segments(asked, ENCODER)
    themed = docs.withColumn("theme", F.lit("Emotion"))
    names = list(STUDY.judge_constructs)
    scores = anchors.score_wide(themed, centroid_table(spark), names)
    # Rounded so that ties, which ranks depend on, are the same everywhere.
    scores = scores.withColumns({f"anchor_{n}": F.round(f"anchor_{n}", 3) for n in names})
    return judge.judged_segments(docs, scores, replies, names)


@query
def judge_parse(spark, sf_dir):
    replies = t.judge_replies(spark, sf_dir)
    return replies.select(
        "segment_id", "construct", r6(judge.parse_reply(F.col("raw"))).alias("judge_score")
    )


@query
def judge_correlation(spark, sf_dir):
    return rounded(judge.judge_correlation(judged(spark, sf_dir)))


@query
def average_ranks(spark, sf_dir):
    df = t.table(spark, sf_dir, "events").select("event_type", "value")
    return ranks.average_ranks(df, "event_type", "value", "rank")


@query
def seeded_sample(spark, sf_dir):
    return ranks.sample_rows(t.table(spark, sf_dir, "documents"), "doc_id", 30, 42).select(
        "doc_id", "lang", "n_chars"
    )


# --- labels and training -------------------------------------------------------


def ad_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_columns(t.raw_labels(spark, sf_dir), score_col="result")


@query
def labels_checked(spark, sf_dir):
    return labels.load_labels(t.raw_labels(spark, sf_dir), score_col="result")


@query
def label_domain_violations(spark, sf_dir):
    raw = t.table(spark, sf_dir, "events").select(
        F.concat(F.lit("AD"), F.col("user_id")).alias("Ad ID"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("band"),
    )
    return labels.unknown_bands(labels.label_columns(raw))


@query
def repeated_labels(spark, sf_dir):
    raw = t.table(spark, sf_dir, "events").select(
        F.concat(F.lit("AD"), F.col("user_id")).alias("Ad ID"), F.col("event_type").alias("band")
    )
    return labels.repeated_ads(labels.label_columns(raw))


def vector_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.ad_features(rollup.respondent_features(vector_scores(spark, sf_dir)))


@query
def features_labels_join(spark, sf_dir):
    df = training.labelled_features(vector_ads(spark, sf_dir), ad_labels(spark, sf_dir))
    return rounded(df)


@query
def unlabelled_ads(spark, sf_dir):
    strong = ad_labels(spark, sf_dir).filter(F.col("band") == "Strong")
    return training.unlabelled_ads(t.vector_segments(spark, sf_dir).select("ad_id").distinct(),
                                   strong)


@query
def binary_target(spark, sf_dir):
    return training.task_labels(ad_labels(spark, sf_dir), "binary")


@query
def strong_weak_target(spark, sf_dir):
    return training.task_labels(ad_labels(spark, sf_dir).drop("score"), "binary")


@query
def label_encoding(spark, sf_dir):
    rows = training.task_labels(ad_labels(spark, sf_dir), "3class")
    return training.encode_target(rows).withColumn("label", F.col("label").cast("bigint"))


@query
def group_folds(spark, sf_dir):
    return big(training.group_folds(ad_labels(spark, sf_dir), 5), "fold")


@query
def balanced_weights(spark, sf_dir):
    rows = training.task_labels(ad_labels(spark, sf_dir), "3class")
    return rounded(training.balanced_weights(rows))


@query
def sample_per_ad(spark, sf_dir):
    df = ranks.sample_per_group(
        t.table(spark, sf_dir, "events").select("event_id", "user_id"),
        ["user_id"],
        ["event_id"],
        10,
        42,
    )
    return big(df, "sample_rank")


def event_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "events").select(
        (F.col("user_id") % 5).alias("fold"),
        (F.col("event_id") % 3).cast("double").alias("label"),
        (F.floor("value") % 3).cast("double").alias("prediction"),
    )


@query
def fold_accuracy(spark, sf_dir):
    return rounded(training.fold_accuracy(event_predictions(spark, sf_dir)))


@query
def fold_r2(spark, sf_dir):
    return rounded(training.fold_r2(event_predictions(spark, sf_dir)))


@query
def cv_summary(spark, sf_dir):
    scores = training.fold_accuracy(event_predictions(spark, sf_dir))
    return rounded(training.score_summary(scores))


@query
def top_drivers(spark, sf_dir):
    table = t.table(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("f"), F.col("user_id")).alias("feature")
    )
    importance = table.agg(F.round(F.avg("value"), 6).alias("importance"))
    return drivers.top_drivers(importance, 15)


@query
def learning_curve_features(spark, sf_dir):
    cells = train_plan.curve_features(cleaned(spark, sf_dir), STUDY)
    return rounded(big(cells, *curve.CELL))


@query
def classifier_cv(spark, sf_dir):
    result = training.train(vector_ads(spark, sf_dir), ad_labels(spark, sf_dir))
    return training.fold_table(spark, result)


@query
def binary_cv(spark, sf_dir):
    result = training.train(
        vector_ads(spark, sf_dir), ad_labels(spark, sf_dir), "binary"
    )
    return training.fold_table(spark, result)


@query
def regressor_cv(spark, sf_dir):
    result = training.train(
        vector_ads(spark, sf_dir), ad_labels(spark, sf_dir), "regression"
    )
    return training.fold_table(spark, result)


@query
def driver_importance(spark, sf_dir):
    result = training.train(
        vector_ads(spark, sf_dir), ad_labels(spark, sf_dir), "binary"
    )
    return drivers.top_drivers(drivers.permutation_importance(result))


@query
def learning_curve(spark, sf_dir):
    cells = train_plan.cut_lineage(
        train_plan.curve_features(cleaned(spark, sf_dir), STUDY)
    )
    return curve.learning_curve(
        cells, ad_labels(spark, sf_dir), STUDY.conversations_grid, STUDY.n_repeats,
        n_splits=STUDY.n_splits, n_trees=STUDY.n_trees,
    )


# --- checks and whole runs -----------------------------------------------------


@query
def embedding_norm_check(spark, sf_dir):
    df = t.vector_segments(spark, sf_dir)
    return df.transform(checks.norm_check).withColumn("value", F.round("value", 5))


@query
def pair_sanity(spark, sf_dir):
    return rounded(checks.pair_check(t.probes(spark, sf_dir)))


@query
def anchor_cohesion(spark, sf_dir):
    return rounded(checks.cohesion_check(t.label_phrases(spark, sf_dir)))


@query
def construct_separation(spark, sf_dir):
    table = anchors.centroids(t.label_phrases(spark, sf_dir))
    return rounded(checks.separation_check(table, list(t.VECTOR_CONSTRUCTS)))


@query
def score_variance(spark, sf_dir):
    return rounded(checks.variance_check(vector_ads(spark, sf_dir)))


@query
def diagnostics(spark, sf_dir):
    return rounded(
        diagnostic_plan.diagnostics(
            t.label_phrases(spark, sf_dir),
            list(t.VECTOR_CONSTRUCTS),
            t.probes(spark, sf_dir),
            vector_ads(spark, sf_dir),
        )
    )


@query
def features_round_trip(spark, sf_dir):
    path = scratch(spark, "ad_features.csv")
    outputs.write_csv(vector_ads(spark, sf_dir), path)
    return big(rounded(outputs.read_features(spark, path)), "n_conversations")


@query
def predict_run(spark, sf_dir):
    result = predict_plan.predict(t.raw_responses(spark, sf_dir), STUDY)
    return rounded(result.ad_features)


def plain_run(spark: SparkSession, sf_dir: str) -> predict_plan.PredictResult:
    """A predict run without topics, all of whose tables SQL can state."""
    study = dataclasses.replace(STUDY, run_discovery=False)
    return predict_plan.predict(t.raw_responses(spark, sf_dir), study)


@query
def predict_ads(spark, sf_dir):
    return rounded(plain_run(spark, sf_dir).ad_features)


@query
def predict_respondents(spark, sf_dir):
    return big(rounded(plain_run(spark, sf_dir).respondent_features), "order_shown")


@query
def predict_counts(spark, sf_dir):
    """Everything a run counts, by the writes themselves."""
    return plain_run(spark, sf_dir).counts


@query
def density_run(spark, sf_dir):
    """A run whose topics, and their number, follow from the density of the vectors."""
    study = dataclasses.replace(STUDY, topic_method="density")
    result = predict_plan.predict(t.raw_responses(spark, sf_dir), study)
    return rounded(result.topic_shares)


@query
def predict_quality(spark, sf_dir):
    return plain_run(spark, sf_dir).quality_report


@query
def kmeans_violations(spark, sf_dir):
    """Points not with the nearest mean of their group, groups that are too small, and shares."""
    rows = topics_kmeans_points(spark, sf_dir)
    kept = rows.filter(F.col("topic_id") != topics.NOISE)
    sizes = kept.groupBy("topic_id").count()
    sums = topics.topic_shares(kept).groupBy("ad_id").agg(F.sum("share").alias("total"))
    small = sizes.agg(F.count_if(F.col("count") < 8).alias("small_groups"))
    wrong = sums.agg(F.count_if(F.abs(F.col("total") - 1) > 1e-9).alias("wrong_shares"))
    lost = rows.agg((F.count(F.lit(1)) - F.count_distinct("segment_id")).alias("repeated_points"))
    return small.select(
        "small_groups",
        wrong.scalar().alias("wrong_shares"),
        lost.scalar().alias("repeated_points"),
    )


@query
def train_scores(spark, sf_dir):
    # The curve, which these scores do not need, is a query of its own.
    run = train_plan.train_run(
        t.raw_responses(spark, sf_dir), ad_labels(spark, sf_dir), STUDY, with_curve=False
    )
    return run.scores
