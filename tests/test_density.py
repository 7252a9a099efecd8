import itertools
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from openends.operators import density


def points(spark, coords):
    rows = [(f"s{i}", None if c is None else [float(x) for x in c]) for i, c in enumerate(coords)]
    return spark.createDataFrame(rows, "segment_id string, coords array<double>")


def found(df):
    return {r.segment_id: r.topic_id for r in df.collect()}


def brute(coords, dim, radius, min_points, min_size, directions, tables, seed=42):
    """The same topics with dictionaries and a union of sets."""
    quantised = [tuple(int(np.floor(abs(x) * density.STEPS / radius + 0.5)) * (1 if x >= 0 else -1)
                       for x in c) for c in coords]
    width = density.WIDTH * density.STEPS * density.UNIT
    parent = list(range(len(coords)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    dense = set()
    for table in density.directions_of(dim, tables, directions, seed):
        buckets = defaultdict(list)
        for i, q in enumerate(quantised):
            cells = tuple((sum(x * a for x, a in zip(q, v, strict=True)) + b) // width for v, b in table)
            buckets[cells].append(i)
        for members in buckets.values():
            mean = np.mean([quantised[i] for i in members], axis=0)
            near = [i for i in members
                    if ((np.array(quantised[i]) - mean) ** 2).sum() <= density.STEPS**2]
            if len(members) >= min_points and len(near) >= min_points:
                dense.update(near)
                for i in near[1:]:
                    parent[root(i)] = root(near[0])
    groups = [root(i) if i in dense else None for i in range(len(coords))]
    return [g if g is not None and groups.count(g) >= min_size else None for g in groups]


def same_groups(topics, expected):
    names = {}
    for i, group in enumerate(expected):
        topic = topics[f"s{i}"]
        assert (topic == -1) == (group is None)
        if group is not None:
            assert names.setdefault(group, topic) == topic
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("dim", [1, 5, 64])
def test_projected_topics_match_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(6, dim)) * 3
    coords = np.concatenate([
        centres[rng.integers(0, 6, 90)] + rng.normal(size=(90, dim)) * 0.5 / np.sqrt(dim),
        rng.normal(size=(20, dim)) * 5,
        np.repeat(rng.normal(size=(1, dim)), 10, axis=0),
    ]).round(3)
    df = density.projected_topics(
        points(spark, coords), dim, 1.0, 3, 8, directions=5, tables=3, rows_per_slice=7
    )
    same_groups(found(df), brute(coords, dim, 1.0, 3, 8, 5, 3))


@pytest.mark.parametrize("dim", [5, 64])
def test_planted_groups_are_found_whole_on_any_partitions(spark, dim):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(12, dim)) * 40 / np.sqrt(dim)
    group = np.repeat(np.arange(12), 40)
    coords = centres[group] + rng.normal(size=(480, dim)) * 0.6 / np.sqrt(dim)
    alone = rng.normal(size=(60, dim)) * 400 / np.sqrt(dim)
    df = points(spark, np.concatenate([coords, alone]))
    first, second = (
        found(density.projected_topics(df.repartition(parts), dim, 1.0)) for parts in (3, 7)
    )
    assert first == second
    topics = [first[f"s{i}"] for i in range(480)]
    assert len(set(topics) - {-1}) == 12
    assert sum(t == -1 for t in topics) <= 0.02 * 480
    assert all(len({t for t, g in zip(topics, group, strict=True) if g == k and t != -1}) == 1
               for k in range(12))
    assert {first[f"s{i}"] for i in range(480, 540)} == {-1}


@pytest.mark.parametrize("dim", [5, 16, 64])
def test_near_points_share_a_bucket_with_the_planned_recall(spark, dim):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(400, dim)) * 3
    step = rng.normal(size=(400, dim))
    pairs = np.stack([base, base + step / np.linalg.norm(step, axis=1, keepdims=True)], axis=1)
    n, tables = density.plan_buckets(10**6)
    plan = density.directions_of(dim, tables, n, 42)
    df = points(spark, pairs.reshape(-1, dim)).select(
        "segment_id", density._buckets(density._steps(F.col("coords"), 1.0), plan).alias("b")
    )
    buckets = {r.segment_id: set(r.b) for r in df.collect()}
    shared = sum(bool(buckets[f"s{2 * i}"] & buckets[f"s{2 * i + 1}"]) for i in range(400))
    assert shared >= 0.9 * 400
    strangers = itertools.combinations(range(0, 800, 8), 2)
    apart = [(i, j) for i, j in strangers
             if np.linalg.norm(pairs.reshape(-1, dim)[i] - pairs.reshape(-1, dim)[j]) > 8]
    met = sum(bool(buckets[f"s{i}"] & buckets[f"s{j}"]) for i, j in apart)
    assert met <= 0.01 * len(apart) + 1


def test_tables_grow_slowly():
    sizes = [density.plan_buckets(10**k) for k in (3, 6, 9)]
    assert [d for d, _ in sizes] == sorted(d for d, _ in sizes)
    assert sizes[-1][1] <= 3 * sizes[0][1] + 10


def test_odd_points_are_noise_and_columns_stay(spark):
    rows = [[1.0, 2.0]] * 9 + [None, [1.0], [float("nan"), 0.0], [float("inf"), 0.0], [0.0, 1e300]]
    df = points(spark, rows).withColumns({"n": F.lit("x"), "bucket": F.lit("y"), "q": F.lit(1)})
    topics = density.projected_topics(df, 2, 0.5)
    assert set(topics.columns) == {*df.columns, "topic_id"}
    ids = found(topics)
    assert len({ids[f"s{i}"] for i in range(9)}) == 1 and ids["s0"] != -1
    assert {ids[f"s{i}"] for i in range(9, 14)} == {-1}
    empty = density.projected_topics(df.limit(0), 2, 0.5)
    assert empty.count() == 0


def test_a_hot_point_and_a_crowded_region_are_one_topic(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("s"), "id").alias("segment_id"),
        F.when(F.col("id") < 1000, F.array(F.lit(0.0), F.lit(0.0)))
        .otherwise(F.array(F.col("id") % 50 / 100.0, F.col("id") % 40 / 100.0)).alias("coords"),
    )
    topics = found(density.projected_topics(df, 2, 1.0, rows_per_slice=100))
    assert len(topics) == 3000 and len(set(topics.values())) == 1 and -1 not in topics.values()
