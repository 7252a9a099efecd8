import dataclasses
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from openends.catalog import queries as q
from openends.catalog import tables
from openends.config import Calibration, Study
from openends.errors import ContractError
from openends.operators.encode import EncoderSettings
from openends.plans import predict as predict_plan
from openends.plans import train as train_plan
from openends.sources import outputs, shared

SMALL = dataclasses.replace(
    Study(), topics=4, min_cluster_size=3, n_splits=2, n_trees=5,
    conversations_grid=(3,), n_repeats=1,
)


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return tables.raw_responses(spark, sf_dir)


@pytest.fixture(scope="module")
def prediction(raw):
    return predict_plan.predict(raw, SMALL)


def test_predict_agrees_with_the_lazy_queries(spark, sf_dir, prediction):
    lazy = {r.ad_id: r for r in q.ad_features(spark, sf_dir).collect()}
    rows = prediction.ad_features.collect()
    assert {r.ad_id for r in rows} == set(lazy)
    for row in rows:
        for name, value in lazy[row.ad_id].asDict().items():
            assert row[name] == (pytest.approx(value, abs=1e-6) if value is not None else None) \
                or name == "ad_id"
    shares = [c for c in prediction.ad_features.columns if c.startswith("topic_share_")]
    assert shares
    for row in rows:
        found = [row[c] for c in shares]
        assert all(x is None for x in found) or sum(found) == pytest.approx(1)


def test_predict_without_discovery_and_with_calibration(raw, prediction):
    study = dataclasses.replace(
        SMALL, run_discovery=False, calibration=Calibration(True, 0, 100)
    )
    result = predict_plan.predict(raw, study)
    assert result.topics is None and result.topic_labels is None
    plain = {r.ad_id: r.anchor_relevance_mean for r in prediction.ad_features.collect()}
    for row in result.ad_features.collect():
        assert row.anchor_relevance_mean == pytest.approx(100 * plain[row.ad_id])


def test_predict_with_quarantined_segments_counts_them(raw, prediction):
    everything = predict_plan.predict(
        raw, dataclasses.replace(SMALL, run_discovery=False, exclude_quarantined=False)
    )
    total = everything.respondent_features.agg(F.sum("n_themes_scored")).first()[0]
    assert total == everything.segments.count()
    scored = prediction.respondent_features.agg(F.sum("n_themes_scored")).first()[0]
    assert scored == prediction.segments.filter("NOT quarantined").count()


def test_bad_settings_and_bad_input_fail_before_work(raw):
    with pytest.raises(ValueError, match="range"):
        predict_plan.predict(raw, dataclasses.replace(SMALL, calibration=Calibration(True)))
    with pytest.raises(ContractError, match="Brand"):
        predict_plan.predict(raw.drop("Brand"), SMALL)
    with pytest.raises(ContractError, match="numbers"):
        predict_plan.predict(raw.withColumn("Order Shown", F.lit("x")), SMALL)


def test_study_without_constructs_still_gives_controls(raw, caplog):
    result = predict_plan.predict(
        raw, dataclasses.replace(SMALL, anchors={}, run_discovery=False)
    )
    assert "no construct is active" in caplog.text
    assert result.ad_features.columns == [
        "ad_id", "order_shown_mean", "order_shown_std", "n_conversations"
    ]
    assert result.ad_features.count() > 0


def test_study_whose_answers_all_fail_the_gate(raw, caplog):
    result = predict_plan.predict(raw, dataclasses.replace(SMALL, min_tokens=10**6))
    assert result.ad_features.count() == result.respondent_features.count() == 0
    assert result.topics is None
    assert "has no score" in caplog.text and "no topics" in caplog.text
    assert result.quality_report.filter("quarantine_rate < 1").count() == 0


def test_outputs_are_written_and_read_back(spark, raw, prediction, tmp_path):
    replies = prediction.scored.filter("theme = 'Emotion'").select(
        "segment_id", F.explode(F.array(F.lit("enjoyability"), F.lit("authenticity")))
        .alias("construct"), F.lit('{"score": 0.5}').alias("raw"),
    )
    report = predict_plan.judge_report(prediction.scored, replies, SMALL)
    result = dataclasses.replace(prediction, judge_report=report)
    outputs.write_prediction(result, str(tmp_path))
    names = {p.name for p in tmp_path.iterdir()}
    assert names == {
        "ad_level_features.csv", "respondent_level_features.csv", "qc_report.csv",
        "topic_labels.json", "judge_report.json", "judge_report.csv",
    }
    raw_csv = spark.read.option("header", True).csv(str(tmp_path / "ad_level_features.csv"))
    assert "Ad ID" in raw_csv.columns and "anchor_relevance_mean" in raw_csv.columns
    ads = outputs.read_features(spark, str(tmp_path / "ad_level_features.csv"))
    found = {r.ad_id: r.anchor_relevance_mean for r in ads.collect()}
    for row in prediction.ad_features.collect():
        assert found[row.ad_id] == pytest.approx(row.anchor_relevance_mean)
    assert report.filter("n > 30").count() == 0


def test_train_run_reports_every_task(spark, sf_dir, raw, tmp_path):
    labels = q.ad_labels(spark, sf_dir)
    run = train_plan.train_run(raw, labels, dataclasses.replace(SMALL, run_discovery=False))
    assert {r.task for r in run.scores.collect()} == {"3class", "binary", "regression"}
    assert set(run.drivers) == {"3class", "binary"}
    assert [r.n_conversations for r in run.learning_curve.collect()] == [3]
    outputs.write_training(run, str(tmp_path))
    assert (tmp_path / "model_report" / "fold_scores.json").exists()
    assert (tmp_path / "model_report" / "learning_curve.json").exists()


def test_curve_scores_each_sampled_segment_once(spark, raw):
    study = dataclasses.replace(SMALL, conversations_grid=(2, 3), n_repeats=2)
    from openends.sources import responses

    cells = train_plan.curve_features(responses.load_responses(raw, study.themes), study)
    rows = cells.collect()
    assert {(r.n_per_ad, r.repeat) for r in rows} == {(n, k) for n in (2, 3) for k in (0, 1)}
    assert all(r.n_conversations <= r.n_per_ad for r in rows)


def test_curve_has_topic_shares_of_its_cells(raw, prediction):
    from openends.sources import responses

    df = responses.load_responses(raw, SMALL.themes)
    cells = train_plan.curve_features(df, SMALL, topic_of=prediction.topics)
    shares = [c for c in cells.columns if c.startswith("topic_share_")]
    wanted = [c for c in prediction.ad_features.columns if c.startswith("topic_share_")]
    assert shares == wanted
    for row in cells.collect():
        found = [row[c] for c in shares]
        assert all(x is None for x in found) or sum(found) == pytest.approx(1)


def test_entry_and_catalog_are_consistent(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["ad_id", "construct", "score_mean", "score_std", "n_scores"]
    assert df.count() > 0
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_no_query_has_a_cross_join(spark, sf_dir):
    fitted = {
        "classifier_cv", "binary_cv", "regressor_cv", "driver_importance", "learning_curve",
        "train_scores", "predict_run", "topics_density", "topics_kmeans",
        "append_round_trip", "features_round_trip", "cached_embedding",
    }
    for name, build in spark_entry.queries().items():
        if name not in fitted:
            plan = build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
            assert not re.search("CartesianProduct|NestedLoop", plan), name


def test_checkpoint_folder_is_taken_from_the_session(spark, monkeypatch):
    assert shared.checkpoint_folder(spark) == spark.sparkContext.getCheckpointDir()
    df = shared.cut_lineage(spark.range(5))
    assert df.count() == 5


def test_answers_and_phrases_are_encoded_once_over_two_runs(raw, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def encode(texts):
        import hashlib
        import uuid

        import numpy as np

        for text in texts:
            (calls / f"{hashlib.md5(text.encode()).hexdigest()}-{uuid.uuid4().hex}").touch()
        return np.array([[len(t), sum(map(ord, t)) % 97 + 1.0] for t in texts])

    study = dataclasses.replace(SMALL, run_discovery=False, output_dim=2)
    encoder = EncoderSettings("counted", 2, encode)
    for _ in range(2):
        result = predict_plan.predict(raw, study, encoder, str(tmp_path / "vectors"))
        assert result.ad_features.count() > 0
    seen = [p.name.split("-")[0] for p in calls.iterdir()]
    phrases = {p for s in study.anchor_sets() for p in s.phrases}
    assert len(seen) == len(set(seen)) > len(phrases)


def test_an_encoder_that_loses_rows_is_refused(spark):
    from openends.errors import EncoderConfigError
    from openends.operators.encode import retrying

    with pytest.raises(EncoderConfigError, match="for 2 texts"):
        retrying(EncoderSettings("short", 2, lambda texts: [[1.0, 2.0]]))(["a", "b"])


def test_counts_of_a_run(raw, prediction):
    counts = {(r.part, r.name): r.n for r in prediction.counts.collect()}
    assert len(counts) == prediction.counts.count()
    n = raw.count()
    assert counts["responses", "rows"] == counts["responses", "kept"] == n
    assert counts["quality", "segments"] == 4 * n == prediction.segments.count()
    usable = prediction.segments.filter("NOT quarantined")
    assert counts["quality", "quarantined"] == 4 * n - usable.count()
    per_theme = {r.theme: r["count"] for r in usable.groupBy("theme").count().collect()}
    assert {k: v for (part, k), v in counts.items() if part == "scoreable" and v} == per_theme
    assert counts["topics", "n_segments"] == usable.count()
    assert counts["topics", "n_noise"] == prediction.topics.filter("topic_id = -1").count()


def test_blank_keys_are_counted_and_the_input_is_not_read_again(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    blank = raw.limit(3).withColumn("Ad ID", F.lit("  "))
    none = raw.limit(2).withColumn("Respondent ID", F.lit(None).cast("string"))
    raw.unionByName(blank).unionByName(none).write.parquet(path)
    study = dataclasses.replace(SMALL, run_discovery=False)
    result = predict_plan.predict(spark.read.parquet(path), study)
    counts = {(r.part, r.name): r.n for r in result.counts.collect()}
    assert counts["responses", "blank_keys"] == 5
    assert counts["responses", "rows"] == counts["responses", "kept"] + 5
    for table in (result.ad_features, result.quality_report):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert path not in plan


def test_an_empty_input_is_counted_as_such(raw):
    result = predict_plan.predict(raw.limit(0), SMALL)
    counts = {(r.part, r.name): r.n for r in result.counts.collect()}
    assert counts["responses", "rows"] == counts["quality", "segments"] == 0
    assert not any(counts.values()) and result.topic_shares is None


def test_density_topics_in_a_run(spark, raw, tmp_path, sf_dir):
    study = dataclasses.replace(
        SMALL, topic_method="density", density_radius=0.9, share_columns=2
    )
    # Every answer three times over, by other respondents: groups that density must find.
    copies = [raw.withColumn("Respondent ID", F.concat(F.lit(f"c{i}"), "Respondent ID"))
              for i in range(2)]
    result = predict_plan.predict(raw.unionByName(copies[0]).unionByName(copies[1]),
                                  dataclasses.replace(study, near_duplicate_min_len=10**6))
    assert result.topics.filter("topic_id <> -1").count() > 0
    shares = result.topic_shares.groupBy("ad_id").agg(F.sum("share").alias("total")).collect()
    assert shares and all(r.total == pytest.approx(1) for r in shares)
    wide = [c for c in result.ad_features.columns if c.startswith("topic_share_")]
    found = result.topics.filter("topic_id <> -1").groupBy("topic_id").count().collect()
    largest = sorted(found, key=lambda r: (-r["count"], r.topic_id))[:2]
    assert {c.removeprefix("topic_share_") for c in wide} == {str(r.topic_id) for r in largest}
    outputs.write_details(result, str(tmp_path))
    written = spark.read.option("header", True).csv(f"{tmp_path}/topic_shares.csv")
    assert written.count() == result.topic_shares.count()
    counts = spark.read.option("header", True).csv(f"{tmp_path}/run_counts.csv")
    assert counts.columns == ["part", "name", "n"] and counts.count() == result.counts.count()
    # The same on the principal components.
    reduced = predict_plan.predict(raw, dataclasses.replace(study, density_dim=4))
    assert reduced.topics.count() == reduced.segments.filter("NOT quarantined").count()


def test_topic_settings_are_checked(raw):
    for change in ({"topic_method": "other"}, {"topic_method": "density", "density_radius": 0}):
        with pytest.raises(ValueError, match="method|radius"):
            predict_plan.predict(raw, dataclasses.replace(SMALL, **change))


def test_cells_of_the_curve_normalise_no_text(raw, monkeypatch):
    """A sampled answer is in some twenty cells; its text is prepared once, before the cells are dealt."""
    responses = predict_plan.response_tables.load_responses(raw, SMALL.themes)
    dealt = []
    plain = train_plan.curve.with_cells

    def with_cells(rows, *more):
        dealt.append(rows.columns)
        return plain(rows, *more)

    monkeypatch.setattr(train_plan.curve, "with_cells", with_cells)
    assert train_plan.curve_features(responses, SMALL).count()
    assert len(dealt) == 1 and "_digest" in dealt[0] and "text" not in dealt[0]
