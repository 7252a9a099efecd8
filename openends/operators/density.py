"""Density topics in any number of dimensions, through buckets of random projections.

Points meet through counts and sums per bucket only, so a crowded region costs counters, not pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openends.operators.components import components
from openends.operators.lookup import ROWS_PER_SLICE, attach_lookup
from openends.operators.topics import NOISE
from openends.sources.shared import stored

# A radius is cut into so many steps: whole numbers make sums and buckets exact.
STEPS = 4096
# Unit of the whole-numbered projection directions.
UNIT = 1024
# Width of a bucket in radii. Two points one radius apart fall into the same
# bucket of one direction with probability 0.90, two points eight radii apart with 0.37.
WIDTH = 8
NEAR, FAR = 0.90, 0.37


def plan_buckets(n_places: int, recall: float = 0.9) -> tuple[int, int]:
    """Directions per table and tables, for so many places.

    Directions are added until strangers in a bucket stay few; tables until two places one radius
    apart share a bucket with probability `recall`. Tables grow with about the tenth root of places.
    """
    directions = max(3, math.ceil(math.log(max(n_places, 2)) / -math.log(FAR)))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - NEAR**directions))
    return directions, max(2, tables)


def directions_of(
    dim: int, tables: int, directions: int, seed: int
) -> list[list[tuple[list[int], int]]]:
    """Per table its directions, each with its offset; whole numbers that follow from the seed."""
    random = np.random.default_rng(seed)
    normal = np.rint(random.normal(size=(tables, directions, dim)) * UNIT).astype(int)
    offsets = random.integers(0, WIDTH * STEPS * UNIT, size=(tables, directions))
    return [
        [(normal[t, k].tolist(), int(offsets[t, k])) for k in range(directions)]
        for t in range(tables)
    ]


def _steps(coords: Column, radius: float) -> Column:
    return F.transform(coords, lambda x: F.round(x * F.lit(STEPS / radius)).cast("bigint"))


def _buckets(steps: Column, plan: list[list[tuple[list[int], int]]]) -> Column:
    """One bucket per table: the table's number and the cell on each of its directions, as bytes.

    A batch meets all directions in one product of whole numbers, so a bucket's edge is the same
    on every machine.
    """
    tables, directions = len(plan), len(plan[0])
    vectors = np.array([a for table in plan for a, _ in table], dtype=np.int64).T
    offsets = np.array([b for table in plan for _, b in table], dtype=np.int64)

    @F.arrow_udf("array<binary>")
    def buckets(rows: pa.Array) -> pa.Array:
        n = len(rows)
        along = rows.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) @ vectors + offsets
        names = np.empty((n, tables, directions + 1), dtype=np.int64)
        names[:, :, 0] = np.arange(tables)
        names[:, :, 1:] = (along // (WIDTH * STEPS * UNIT)).reshape(n, tables, directions)
        fixed = pa.binary(8 * (directions + 1))
        named = pa.Array.from_buffers(fixed, n * tables, [None, pa.py_buffer(names)])
        ends = pa.array(np.arange(n + 1) * tables, pa.int32())
        return pa.ListArray.from_arrays(ends, named.cast(pa.binary()))

    return buckets(steps)


def projected_topics(
    points: DataFrame,
    dim: int,
    radius: float,
    min_points: int = 3,
    min_cluster_size: int = 8,
    directions: int | None = None,
    tables: int | None = None,
    seed: int = 42,
    key: str = "segment_id",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Density groups of `coords`, arrays of `dim` numbers, for any `dim`.

    Every distinct point falls into one bucket per table. In a bucket only points within `radius` of
    the mean of its rows count; with at least `min_points` rows of them the bucket
    is dense and links them. Linked points form a topic if it has `min_cluster_size` rows or more;
    the rest, and points with a NULL, a number that is not finite or another number of
    coordinates, is noise. So no link is longer than two radii, whatever
    the data, and two points one radius apart share a bucket with the probability of
    `plan_buckets`, which sets `directions` and `tables` if they are not given.

    `points` is read twice; where its coordinates are costly, it is better stored before.

    Work is places times tables: counts, sums and two joins per bucket, with hot buckets and
    hot places in slices. Coordinates are rounded to radius / 4096, so the topics, and their ids, hashes
    of the smallest point of a group, do not depend on partitions. All columns of `points` stay.
    """
    usable = (F.size("coords") == dim) & F.forall(
        "coords", lambda x: F.coalesce(F.abs(x) < F.lit(radius * 2.0**31), F.lit(False))
    )
    steps = F.when(usable, _steps(F.col("coords"), radius))
    placed = points.withColumn("_place", F.md5(F.array_join(steps, ",")))
    # The steps come before the filter's column, so a filter does not have them computed again.
    distinct = points.filter(usable).select(_steps(F.col("coords"), radius).alias("q"))
    distinct = distinct.select(F.md5(F.array_join("q", ",")).alias("_place"), "q")
    places = stored(
        distinct.groupBy("_place").agg(F.count(F.lit(1)).alias("n"), F.first("q").alias("q")),
        "places",
    )
    if directions is None or tables is None:
        fitted = plan_buckets(places.count())
        directions, tables = directions or fitted[0], tables or fitted[1]
    plan = directions_of(dim, tables, directions, seed)
    # The numbers of a place are not repeated for each of its buckets yet.
    hits = stored(
        places.select("_place", "n", F.explode(_buckets(F.col("q"), plan)).alias("bucket")),
        "buckets",
    )
    # Counts come first: the sums below are only taken where a bucket can be dense.
    crowded = (
        hits.groupBy("bucket")
        .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("rows") >= min_points)
    )
    place_hash = F.xxhash64("_place")
    hits = attach_lookup(hits, crowded, ["bucket"], place_hash, "inner", rows_per_slice)
    hits = stored(hits.join(places.select("_place", "q"), "_place"), "buckets")
    sums = [F.sum(F.col("q")[i] * F.col("n")) for i in range(dim)]
    means = hits.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.transform(F.array(*sums), lambda s: s / F.max("rows")).alias("mean"),
    )
    apart = F.aggregate(
        F.zip_with("q", "mean", lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda s, x: s + x
    )
    near = stored(
        attach_lookup(hits, means, ["bucket"], place_hash, "inner", rows_per_slice)
        .filter(apart <= float(STEPS) ** 2)
        .select("_place", "bucket", "n"),
        "near",
    )
    dense = (
        near.groupBy("bucket")
        .agg(
            F.sum("n").alias("rows"),
            F.count(F.lit(1)).alias("n_rows"),
            F.min("_place").alias("hub"),
        )
        .filter(F.col("rows") >= min_points)
        .drop("rows")
    )
    links = stored(
        attach_lookup(near, dense, ["bucket"], place_hash, "inner", rows_per_slice)
        .select("_place", "n", "hub")
        .distinct(),
        "links",
    )
    found = components(links, "_place", "hub").withColumnRenamed("node", "_place")
    members = links.select("_place", F.col("n").alias("n_rows")).distinct()
    labelled = members.join(found, "_place", "left").withColumn(
        "label", F.coalesce("component", "_place")
    )
    sizes = labelled.groupBy("label").agg(
        F.sum("n_rows").alias("size"), F.count(F.lit(1)).alias("n_rows")
    )
    large = sizes.filter(F.col("size") >= min_cluster_size).drop("size")
    # 52 bits stay exact wherever an id ends up as a floating point number.
    topic_id = F.conv(F.substring("label", 1, 13), 16, 10).cast("bigint")
    lookup = attach_lookup(labelled, large, ["label"], place_hash, "inner", rows_per_slice).select(
        "_place", "n_rows", topic_id.alias("topic_id")
    )
    joined = attach_lookup(
        placed,
        lookup,
        ["_place"],
        F.xxhash64(key),
        rows_per_slice=rows_per_slice,
        may_match=F.col("_place").isNotNull(),
    )
    return joined.withColumn("topic_id", F.coalesce("topic_id", F.lit(NOISE))).drop("_place")
