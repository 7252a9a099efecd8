import itertools
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from openends.operators import topics

SCHEMA = "segment_id string, ad_id string, topic_id int, text string"


def assigned(spark, rows):
    return spark.createDataFrame([(f"s{i}", *r) for i, r in enumerate(rows)], SCHEMA)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-1, 3)), min_size=1, max_size=30))
def test_shares_sum_to_one_without_noise(spark, pairs):
    df = assigned(spark, [(ad, topic, "") for ad, topic in pairs])
    shares = topics.topic_shares(df).collect()
    totals = defaultdict(float)
    for r in shares:
        assert r.topic_id != -1
        totals[r.ad_id] += r.share
    assert set(totals) == {ad for ad, topic in pairs if topic != -1}
    assert all(math.isclose(v, 1) for v in totals.values())
    wide = topics.topic_shares_wide(topics.topic_shares(df), [0, 1, 2, 3]).collect()
    assert all(math.isclose(sum(r[1:]), 1) for r in wide)
    summary = topics.topic_summary(df).first()
    assert summary.n_noise == sum(t == -1 for _, t in pairs)
    assert summary.n_topics == len({t for _, t in pairs} - {-1})


def test_labels_name_the_distinctive_terms(spark):
    df = assigned(spark, [
        ("a", 0, "the dog dog barks in this advert"), ("a", 0, "a dog ran, advert"),
        ("b", 1, "the music music is loud advert"), ("b", 1, "x"), ("b", -1, "noise words"),
    ])
    weights = topics.topic_terms(df, stop_words=["the", "in", "this", "is"])
    labels = {r.topic_id: r.label for r in topics.topic_labels(weights, 2).collect()}
    assert labels == {0: "dog, advert", 1: "music, loud"}
    found = {(r.topic_id, r.term): r.weight for r in weights.collect()}
    assert found[0, "dog"] == pytest.approx(3 / 7 * math.log(3))
    assert found[1, "advert"] == pytest.approx(1 / 4 * math.log(2))
    assert not any(term in ("x", "noise", "the") for _, term in found)


def test_vocabulary_cap_changes_the_denominator(spark):
    df = assigned(spark, [("a", 0, "dog dog cat"), ("a", 1, "dog owl")])
    found = {(r.topic_id, r.term): r.weight for r in topics.topic_terms(df, [], 1).collect()}
    assert found == {
        (0, "dog"): pytest.approx(math.log(2)), (1, "dog"): pytest.approx(math.log(2))
    }


def test_only_stop_words_gives_no_labels(spark):
    df = assigned(spark, [("a", 0, "the and"), ("a", 1, "of")])
    assert topics.topic_labels(topics.topic_terms(df)).count() == 0


def points(spark, coords):
    rows = [(f"s{i}", "a", [float(x) for x in c]) for i, c in enumerate(coords)]
    return spark.createDataFrame(rows, "segment_id string, ad_id string, coords array<double>")


def test_kmeans_finds_groups_and_small_ones_are_noise(spark):
    rng = np.random.default_rng(1)
    coords = np.concatenate([rng.normal(c, 0.05, (n, 2)) for c, n in ((0, 30), (5, 20), (-9, 2))])
    df = topics.kmeans_topics(points(spark, coords), k=3, min_cluster_size=5)
    found = {r.segment_id: r.topic_id for r in df.collect()}
    groups = [found[f"s{i}"] for i in range(52)]
    assert len(set(groups[:30])) == len(set(groups[30:50])) == 1
    assert groups[0] != groups[30] and set(groups[50:]) == {-1}


def test_pca_keeps_row_and_dimension(spark):
    rng = np.random.default_rng(2)
    rows = [(f"s{i}", rng.normal(size=6).tolist()) for i in range(20)]
    df = spark.createDataFrame(rows, "segment_id string, vector array<float>")
    reduced = topics.reduce_pca(df, 3).collect()
    assert len(reduced) == 20 and all(len(r.coords) == 3 for r in reduced)


def brute_density(coords, cell_size, min_points, min_cluster_size):
    cells = [tuple(math.floor(x / cell_size) for x in c) for c in coords]
    dense = {c for c, n in Counter(cells).items() if n >= min_points}
    parent = {c: c for c in dense}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for a, b in itertools.combinations(dense, 2):
        if all(abs(x - y) <= 1 for x, y in zip(a, b, strict=True)):
            parent[root(a)] = root(b)
    groups = [root(c) if c in dense else None for c in cells]
    sizes = Counter(groups)
    return [g if g is not None and sizes[g] >= min_cluster_size else None for g in groups]


@pytest.mark.parametrize("dim, seed", [(1, 0), (2, 1), (2, 2), (3, 3)])
def test_density_groups_match_brute_force(spark, dim, seed):
    rng = np.random.default_rng(seed)
    coords = rng.normal(size=(120, dim)).round(3).tolist()
    expected = brute_density(coords, 0.5, 2, 6)
    found = {
        r.segment_id: r.topic_id
        for r in topics.density_topics(points(spark, coords), dim, 0.5, 2, 6).collect()
    }
    assert len(found) == 120
    names = {}
    for i, group in enumerate(expected):
        topic = found[f"s{i}"]
        assert (topic == -1) == (group is None)
        if group is not None:
            assert names.setdefault(group, topic) == topic
    assert len(set(names.values())) == len(names)


def test_density_follows_long_chains_and_copies(spark):
    chain = [[0.5 + i, 0.5] for i in range(30) for _ in range(2)]
    copies = [[100.2, 100.2]] * 50
    df = topics.density_topics(points(spark, chain + copies + [[50, 50]]), 2, 1.0, 2, 5)
    found = {r.segment_id: r.topic_id for r in df.collect()}
    assert len({found[f"s{i}"] for i in range(60)}) == 1
    assert len({found[f"s{i}"] for i in range(60, 110)}) == 1
    assert found["s110"] == -1 and found["s0"] != found["s60"]


def test_groups_do_not_depend_on_partitions(spark):
    points = spark.range(600).select(
        F.concat(F.lit("s"), "id").alias("segment_id"),
        F.array(*[(F.xxhash64("id", F.lit(i)) % 1000 / 1000.0 + F.col("id") % 4).cast("double")
                  for i in range(5)]).alias("coords"),
    )
    found = []
    for parts in (3, 7):
        rows = topics.kmeans_topics(points.repartition(parts), 10, 3).collect()
        found.append({r.segment_id: r.topic_id for r in rows})
    assert found[0] == found[1] and len(set(found[0].values())) > 3
