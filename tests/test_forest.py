"""Forests of many tables in one plan, against trees grown one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from openends.operators import curve, forest


def table(spark, n, cells=((5, 0), (5, 1), (10, 0)), folds=5):
    rng = np.random.default_rng(n)
    rows = []
    for size, repeat in cells:
        for i in range(n):
            x = [float(i % 3) + rng.normal(0, 0.05), rng.normal(), 1.0, float(rng.integers(3))]
            rows.append((size, repeat, f"AD{i}", float(i % 3), i % folds, x))
    return spark.createDataFrame(
        rows, "n_per_ad int, repeat int, ad_id string, label double, fold int, x array<double>"
    )


def predictions(rows, **more):
    out = forest.cross_validate(rows, curve.CELL, 3, **more).collect()
    return {(r.n_per_ad, r.repeat, r.fold, r.ad_id): r.prediction for r in out}


def test_tables_fitted_together_equal_single_fits(spark):
    rows = table(spark, 60)
    together = predictions(rows.repartition(5), n_trees=30)
    assert len(together) == 180
    for size, repeat in ((5, 0), (5, 1), (10, 0)):
        alone = predictions(rows.filter((F.col("n_per_ad") == size) & (F.col("repeat") == repeat)), n_trees=30)
        assert alone == {k: v for k, v in together.items() if k[:2] == (size, repeat)}


def test_a_feature_that_separates_is_found(spark):
    rows = table(spark, 90, cells=((5, 0),))
    got = predictions(rows, n_trees=25)
    assert all(v == int(ad[2:]) % 3 for (_, _, _, ad), v in got.items())


def test_long_tables_are_sampled_and_scored_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(forest, "MAX_SAMPLE", 40)
    monkeypatch.setattr(forest, "BLOCK", 7)
    got = predictions(table(spark, 300, cells=((5, 0),)), n_trees=40)
    assert len(got) == 300
    assert np.mean([v == int(ad[2:]) % 3 for (_, _, _, ad), v in got.items()]) > 0.97


@pytest.mark.parametrize("seed", range(5))
def test_the_best_cut_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 6, 30).astype(float)
    weight = np.zeros((30, 3))
    weight[np.arange(30), rng.integers(0, 3, 30)] = rng.integers(1, 4, 30)

    def gini(part):
        total = part.sum(axis=0)
        return total.sum() - (total**2).sum() / total.sum()

    cuts = np.unique(x)
    middles = (cuts[1:] + cuts[:-1]) / 2
    least = min(gini(weight[x <= m]) + gini(weight[x > m]) for m in middles)
    left_over, threshold = forest.best_split(x, weight)
    assert np.isclose(left_over, least)
    assert np.isclose(gini(weight[x <= threshold]) + gini(weight[x > threshold]), least)
    assert forest.best_split(np.ones(5), weight[:5]) is None


def test_trees_learn_their_rows_and_stop_at_equal_inputs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 4))
    label = rng.integers(0, 3, 50)
    weight = np.eye(3)[label]
    nodes, shares = forest.grow(x, weight, rng, 2)
    assert (forest.votes(nodes, shares, x).argmax(axis=1) == label).all()
    nodes, shares = forest.grow(np.ones((4, 2)), np.eye(3)[[0, 1, 1, 2]], rng, 1)
    assert len(nodes) == 1 and np.allclose(shares, [[0.25, 0.5, 0.25]])


def test_a_long_table_is_learned_whole(spark):
    """One ad in 3,000 differs, and only by its own input: a forest on a sample of the table misses it."""
    rows = [(0, f"AD{i}", float(i % 1_500 == 7), i % 1_500 // 750, [float(i % 1_500 == 7)] * 2) for i in range(9_000)]
    df = spark.createDataFrame(rows, "table int, ad_id string, label double, fold int, x array<double>")
    df = df.withColumn("fold", (F.substring("ad_id", 3, 9).cast("int") / 1_500).cast("int") % 2)
    got = {r.ad_id: r.prediction for r in forest.cross_validate(df, ["table"], 2, n_trees=30).collect()}
    assert len(got) == 9_000 and {a for a, p in got.items() if p} == {f"AD{i}" for i in range(7, 9_000, 1_500)}


def test_numbers_are_cut_where_the_squared_error_falls_most():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, (60, 1)).astype(float), rng.normal(size=60)
    stats = np.vstack([y, np.ones(60)])
    nodes, means, _ = forest.grow_trees(*forest._codes(x), y, stats, np.ones((1, 60)), rng, 1)[0]
    squares = lambda part: ((part - part.mean()) ** 2).sum()
    cuts = [(a + b) / 2 for a, b in zip(np.unique(x)[:-1], np.unique(x)[1:], strict=True)]
    best = min(cuts, key=lambda c: squares(y[x[:, 0] <= c]) + squares(y[x[:, 0] > c]))
    assert nodes["threshold"][0] == best
    known = forest.votes(nodes, means, x)[:, 0]
    assert all(np.isclose(known[i], y[x[:, 0] == x[i, 0]].mean()) for i in range(60))


def test_empty_tables_and_single_folds_have_no_rows(spark):
    rows = table(spark, 6)
    assert predictions(rows.limit(0), n_trees=3) == {}
    assert predictions(rows.withColumn("fold", F.lit(0)), n_trees=3) == {}


def test_learning_curve_finds_the_signal_in_every_cell(spark):
    rows = [(n, r, f"AD{i}", float(i % 3), None if i % 7 else 0.3) for n in (5, 10) for r in (0, 1) for i in range(45)]
    cells = spark.createDataFrame(
        rows, "n_per_ad int, repeat int, ad_id string, signal double, gaps double"
    )
    names = ["Strong", "Average", "Weak"]
    bands = spark.createDataFrame([(f"AD{i}", names[i % 3]) for i in range(45)], "ad_id string, band string")
    got = curve.learning_curve(cells, bands, [5, 10], 2, n_splits=3, n_trees=15).collect()
    assert {(r.n_conversations, r.n_repeats, r.mean_accuracy, r.std_accuracy) for r in got} == {
        (5, 2, 1.0, 0.0), (10, 2, 1.0, 0.0),
    }
