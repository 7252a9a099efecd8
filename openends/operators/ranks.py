"""Exact global positions and ranks without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded_hash(seed: Column | int, *keys: Column) -> Column:
    """Repeatable pseudo-random order: MD5 of seed and keys."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.md5(F.concat_ws("|", seed.cast("string"), *[k.cast("string") for k in keys]))


def shuffled_positions(rows: DataFrame, key: str, seed: int, position: str) -> DataFrame:
    """Number rows 0..n-1 in seeded pseudo-random order, `key` being unique.

    The order's first three hex digits cut the rows into 4,096 even ranges. Each
    range is numbered on its own and moved by the count of the ranges before it.
    """
    ordered = rows.withColumn("_order", seeded_hash(seed, F.col(key))).withColumn(
        "_range", F.substring("_order", 1, 3)
    )
    counts = ordered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # At most 4,096 rows by construction, so one task and a broadcast are safe.
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    starts = counts.select("_range", before.alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("_order", key))
    return (
        ordered.withColumn("_number", within)
        .join(F.broadcast(starts), "_range")
        .withColumn(position, F.col("_start") + F.col("_number") - 1)
        .drop("_order", "_range", "_number", "_start")
    )


def average_ranks(
    rows: DataFrame, group: str, value: str, rank: str, ranges: int = 64
) -> DataFrame:
    """Average rank of each distinct value per group, with its number of rows.

    Equal values are combined first. Approximate quantiles then cut each group
    into even ranges; they only balance the work, the ranks are exact. Groups are
    constructs, so the quantile and range tables are bounded by the settings:
    constructs x `ranges` rows. Missing values have no rank and move no other.
    """
    fractions = [(i + 1) / ranges for i in range(ranges - 1)]
    counted = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    cuts = counted.groupBy(group).agg(
        F.percentile_approx(value, fractions, 1000).alias("_cuts")
    )
    placed = (
        counted.join(F.broadcast(cuts), group)
        .withColumn("_range", F.size(F.filter("_cuts", lambda cut: cut < F.col(value))))
        .drop("_cuts")
    )
    totals = placed.groupBy(group, "_range").agg(F.sum("_n").alias("_total"))
    by_group = Window.partitionBy(group).orderBy("_range")
    starts = totals.select(
        group, "_range", (F.sum("_total").over(by_group) - F.col("_total")).alias("_start")
    )
    up_to = F.sum("_n").over(Window.partitionBy(group, "_range").orderBy(value))
    return (
        placed.withColumn("_up_to", up_to)
        .join(F.broadcast(starts), [group, "_range"])
        .select(
            group,
            value,
            (F.col("_start") + F.col("_up_to") - (F.col("_n") - 1) / 2.0).alias(rank),
            F.col("_n").alias("n_rows"),
        )
    )


def sample_rows(rows: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """Seeded sample of exactly min(size, n) rows: a top-k by hash, no full sort."""
    return (
        rows.withColumn("_order", seeded_hash(seed, F.col(key)))
        .orderBy("_order", key)
        .limit(size)
        .drop("_order")
    )


def sample_per_group(
    rows: DataFrame,
    group: Sequence[str],
    key: Sequence[str],
    size: int,
    seed: Column | int,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Seeded sample of min(size, n) rows per group, with its `sample_rank`.

    `ties` orders rows that share a key.

    The filter sits directly on the row number, so Spark cuts every group to
    `size` rows in each task before the shuffle; a hot group costs no more.
    """
    ordered = rows.withColumn("_order", seeded_hash(seed, *[F.col(k) for k in key]))
    number = F.row_number().over(Window.partitionBy(*group).orderBy("_order", *key, *ties))
    return ordered.withColumn("sample_rank", number).filter(F.col("sample_rank") <= size).drop(
        "_order"
    )
