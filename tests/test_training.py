import numpy as np
import pytest
from pyspark.sql import functions as F

from openends.errors import ContractError
from openends.operators import curve, drivers, training
from openends.sources import labels

BANDS = ["Strong", "Average", "Weak"]


@pytest.fixture(scope="module")
def ads(spark):
    """Sixty ads: `signal` gives the band away, `noise` does not."""
    rng = np.random.default_rng(0)
    rows = [
        (f"AD{i}", float(i % 3) + rng.normal(0, 0.05), rng.normal(), None if i % 5 else 0.5, 30 + i)
        for i in range(60)
    ]
    return spark.createDataFrame(
        rows, "ad_id string, signal double, noise double, gaps double, n_conversations bigint"
    ).cache()


@pytest.fixture(scope="module")
def ad_labels(spark):
    rows = [(f"AD{i}", BANDS[i % 3], float(90 - 40 * (i % 3) + i % 2)) for i in range(57)]
    return spark.createDataFrame(rows, "ad_id string, band string, score double").cache()


def raw_labels(spark, *rows):
    return spark.createDataFrame(list(rows), "`Ad ID` string, band string, result int, extra string")


def test_labels_are_renamed_and_checked(spark):
    found = labels.load_labels(
        raw_labels(spark, (" AD1 ", "Strong", 98, "x"), ("AD2", None, 3, "y")), score_col="result"
    )
    assert found.columns == ["ad_id", "band", "score"]
    assert [tuple(r) for r in found.orderBy("ad_id").collect()] == [
        ("AD1", "Strong", 98.0), ("AD2", None, 3.0)
    ]
    assert labels.load_labels(raw_labels(spark, ("A", "Weak", 1, ""))).columns == ["ad_id", "band"]


def test_bad_labels_raise(spark):
    with pytest.raises(ContractError, match="Great"):
        labels.load_labels(raw_labels(spark, ("AD1", "Great", 1, "")))
    with pytest.raises(ContractError, match="AD1"):
        labels.load_labels(raw_labels(spark, ("AD1", "Weak", 1, ""), ("AD1", "Weak", 2, "")))
    with pytest.raises(ContractError, match="band"):
        labels.load_labels(raw_labels(spark, ("AD1", "Weak", 1, "")).drop("band"))


def test_binary_target_uses_the_median_of_all_labels(spark):
    df = spark.createDataFrame(
        [("a", "Strong", 1.0), ("b", "Weak", 2.0), ("c", "Average", 3.0)],
        "ad_id string, band string, score double",
    )
    found = {r.ad_id: r.target for r in training.task_labels(df, "binary").collect()}
    assert found == {"a": "Bottom", "b": "Top", "c": "Top"}
    without = {r.ad_id: r.target for r in training.task_labels(df.drop("score"), "binary").collect()}
    assert without == {"a": "Strong", "b": "Weak"}
    with pytest.raises(ValueError, match="unknown task"):
        training.task_labels(df, "4class")
    with pytest.raises(ValueError, match="score"):
        training.task_labels(df.drop("score"), "regression")


def test_join_fills_missing_and_reports_unlabelled(ads, ad_labels):
    joined = training.labelled_features(ads, ad_labels)
    assert joined.count() == 57
    assert joined.filter("gaps IS NULL").count() == 0
    assert training.unlabelled_ads(ads, ad_labels).count() == 3
    assert training.feature_names(ads) == ["signal", "noise", "gaps"]


def test_folds_split_ads_evenly_and_never_a_group(spark, ads):
    twice = ads.select("ad_id").unionAll(ads.select("ad_id"))
    folds = training.group_folds(twice, 7).collect()
    assert len(folds) == len({r.ad_id for r in folds}) == 60
    sizes = [sum(r.fold == f for r in folds) for f in range(7)]
    assert sorted(sizes) == [8, 8, 8, 9, 9, 9, 9]


def test_balanced_weights(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "target string")
    found = {r.target: r.weight for r in training.balanced_weights(df).collect()}
    assert found == {"a": pytest.approx(4 / 6), "b": 2.0}


def test_fold_metrics(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 1.0), (0, 2.0, 1.0), (1, 3.0, 3.0), (1, 3.0, 1.0)],
        "fold int, label double, prediction double",
    )
    assert {r.fold: r.score for r in training.fold_accuracy(df).collect()} == {0: 0.5, 1: 0.5}
    assert {r.fold: r.score for r in training.fold_r2(df).collect()} == {0: -1.0, 1: None}
    scores = spark.createDataFrame([(0.5,), (1.0,)], "score double")
    assert tuple(training.score_summary(scores).first()) == (0.75, 0.25, 2)


def test_classifier_learns_and_drivers_find_the_signal(spark, ads, ad_labels):
    result = training.train(ads, ad_labels, "3class", n_splits=3, n_trees=10)
    assert len(result.fold_scores) == 3 and result.mean_score > 0.9
    table = training.fold_table(spark, result)
    assert table.count() == 3
    importance = drivers.permutation_importance(result)
    assert importance.count() == 3
    best = drivers.top_drivers(importance, 1).first()
    assert best.feature == "signal" and best.importance > 0.3
    assert drivers.top_drivers(drivers.tree_importance(result), 1).first().feature == "signal"


def test_permutation_changes_one_feature_and_keeps_the_rest(ads, ad_labels):
    rows, names = training.training_rows(ads, ad_labels, "3class", 3, 1)
    original = {r.ad_id: r.features.toArray() for r in rows.collect()}
    permuted = drivers.permuted_rows(rows.select("ad_id", "label", "features"), 3, 9).collect()
    assert len(permuted) == 57 * 3
    for slot in range(3):
        part = {r.ad_id: r.features.toArray() for r in permuted if r.slot == slot}
        others = [i for i in range(3) if i != slot]
        assert all((part[a][others] == original[a][others]).all() for a in original)
        assert sorted(v[slot] for v in part.values()) == sorted(v[slot] for v in original.values())


def test_regressor_and_boosting(ads, ad_labels):
    forest = training.train(ads, ad_labels, "regression", n_splits=2, n_trees=10)
    assert forest.metric == "r2" and forest.mean_score > 0.9
    boosted = training.train(ads, ad_labels, "binary", "gradient_boosting", n_splits=2, n_trees=3)
    assert boosted.mean_score > 0.8
    several = training.train(ads, ad_labels, "3class", "gradient_boosting", n_splits=2, n_trees=2)
    assert several.mean_score > 0.8
    reg = training.train(ads, ad_labels, "regression", "gradient_boosting", n_splits=2, n_trees=20)
    assert reg.mean_score > 0.7


@pytest.mark.parametrize("task", ["3class", "regression"])
def test_a_forest_is_a_table_and_its_predictions_do_not_depend_on_partitions(spark, ads, ad_labels, task):
    """Trees are rows in the shared folder: Spark's own forests hold them all on the driver."""
    results = [training.train(part, ad_labels, task, n_splits=3, n_trees=7) for part in (ads, ads.repartition(5))]
    assert results[0].fold_scores == results[1].fold_scores
    first, second = (r.model for r in results)
    assert first.trees.count() == 7
    rows = results[0].rows
    predicted = [{r.ad_id: r.prediction for r in m.transform(rows.repartition(3)).collect()} for m in (first, second)]
    assert predicted[0] == predicted[1] and len(predicted[0]) == 57
    label = {r.ad_id: r.label for r in rows.collect()}
    assert np.mean([abs(predicted[0][a] - label[a]) < 2 for a in label]) > 0.9


def test_too_few_ads_or_unknown_model_raise(spark, ads, ad_labels):
    with pytest.raises(ValueError, match="at least 2"):
        training.train(ads, ad_labels.filter("ad_id = 'AD1'"))
    with pytest.raises(ValueError, match="unknown model"):
        training.train(ads, ad_labels, model_name="perceptron", n_splits=2)
    few = training.train(ads, ad_labels.filter("ad_id IN ('AD1', 'AD2', 'AD3')"), n_trees=2)
    assert len(few.fold_scores) == 3


def test_curve_samples_are_nested_and_sized(spark):
    rows = [(f"a{i % 3}", f"r{i}", i) for i in range(30)]
    df = spark.createDataFrame(rows, "ad_id string, respondent_id string, row_seq bigint")
    sample = curve.sampled_responses(df, [2, 5, 50], 2, 1)
    cells = curve.with_cells(df, sample, [2, 5, 50]).toPandas()
    sizes = cells.groupby(["n_per_ad", "repeat", "ad_id"]).size()
    assert set(sizes.loc[2]) == {2} and set(sizes.loc[5]) == {5} and set(sizes.loc[50]) == {10}
    small = cells[(cells.n_per_ad == 2) & (cells.repeat == 0)]
    large = cells[(cells.n_per_ad == 5) & (cells.repeat == 0)]
    assert set(small.respondent_id) < set(large.respondent_id)
    assert curve.sampled_once(df, sample).count() == 30


def test_learning_curve_has_a_row_per_size_and_skips_broken_cells(ads, ad_labels):
    cells = ads.withColumn("repeat", F.lit(0))
    good = cells.withColumn("n_per_ad", F.lit(5))
    lone = cells.filter("ad_id = 'AD1'").withColumn("n_per_ad", F.lit(2))
    table = curve.learning_curve(
        good.unionByName(lone), ad_labels, [2, 5], 1, n_splits=2, n_trees=5
    ).collect()
    assert [r.n_conversations for r in table] == [5]
    assert table[0].mean_accuracy > 0.6 and table[0].std_accuracy == 0.0


def test_cells_keep_their_size_when_rows_repeat(spark):
    rows = [("a", f"r{i}", i) for i in range(6)] + [("a", "r1", 1), ("a", "r1", 99)]
    df = spark.createDataFrame(rows, "ad_id string, respondent_id string, row_seq bigint")
    sample = curve.sampled_responses(df, [2, 3], 4, 1)
    cells = curve.with_cells(df.dropDuplicates(), sample, [2, 3])
    sizes = cells.groupBy("n_per_ad", "repeat").agg(F.count_distinct("respondent_id").alias("n"))
    assert all(r.n == r.n_per_ad for r in sizes.collect())
    assert cells.filter("row_seq = 1").groupBy("n_per_ad", "repeat").count().filter("count > 1").isEmpty()
