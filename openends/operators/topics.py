"""Topic discovery: group vectors, label the groups, share of topics per ad.

Topic -1 is noise: it is kept in the assignments and left out of labels and
shares.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openends.functions import text as tx
from openends.operators.components import components
from openends.operators.lookup import attach_lookup
from openends.sources.shared import cut_lineage

NOISE = -1
# Points, chosen by hash, that starting centres are taken from.
CENTRE_SAMPLE = 2_000


def reduce_pca(vectors: DataFrame, dim: int, column: str = "vector") -> DataFrame:
    """Add `coords`, the first principal components of the vectors."""
    points = vectors.withColumn("_point", array_to_vector(F.col(column)))
    model = PCA(k=dim, inputCol="_point", outputCol="_coords").fit(points)
    return (
        model.transform(points)
        .withColumn("coords", vector_to_array("_coords"))
        .drop("_point", "_coords")
    )


def _spread_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Starting centres: points of the sample, drawn by their squared distance to those drawn."""
    random = np.random.default_rng(seed)
    centres = [sample[0]]
    while len(centres) < min(k, len(sample)):
        apart = ((sample[:, None, :] - np.array(centres)[None]) ** 2).sum(axis=2).min(axis=1)
        if apart.sum() <= 0:
            break
        at = np.searchsorted(np.cumsum(apart), random.random() * apart.sum(), side="right")
        centres.append(sample[min(at, len(sample) - 1)])
    return np.array(centres)


def nearest(coords: Column, centres: np.ndarray) -> Column:
    """Number of the centre next to a point, the first of equals."""
    apart = F.transform(
        F.lit(centres.tolist()),
        lambda c: F.aggregate(
            F.zip_with(coords, c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
        ),
    )
    least = F.array_min(F.transform(apart, lambda d, i: F.struct(d.alias("d"), i.alias("i"))))
    return least["i"]


def kmeans_topics(
    points: DataFrame,
    k: int,
    min_cluster_size: int = 8,
    seed: int = 42,
    rounds: int = 20,
    key: str = "segment_id",
) -> DataFrame:
    """Assign every point to one of k groups by its `coords`; small groups are noise.

    The groups depend on the points and the seed, not on partitions: starting centres come from
    the CENTRE_SAMPLE points of smallest seeded hash, a round's means are rounded, and groups are
    numbered in the order of their centres. A round reads the coordinates once, and k
    rows of sums come back.
    """
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    narrow = cut_lineage(points.select(order.alias("order"), "coords"))
    chosen = narrow.orderBy("order", "coords").limit(CENTRE_SAMPLE).collect()
    if not chosen:
        return points.withColumn("topic_id", F.lit(NOISE))
    centres = _spread_centres(np.array([r.coords for r in chosen], dtype=float), k, seed)
    sums = [F.sum(F.col("coords")[i]).alias(f"s{i}") for i in range(centres.shape[1])]
    for _ in range(rounds):
        grouped = narrow.select(nearest(F.col("coords"), centres).alias("group"), "coords")
        means = centres.copy()
        for r in grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
            means[r.group] = [round(r[f"s{i}"] / r.n, 9) for i in range(centres.shape[1])]
        moved = float(np.abs(means - centres).max())
        centres = means
        if moved < 1e-7:
            break
    centres = centres[np.lexsort(centres.T[::-1])]
    assigned = points.withColumn("_group", nearest(F.col("coords"), centres))
    # At most k sizes.
    sizes = narrow.select(nearest(F.col("coords"), centres).alias("group")).groupBy("group").count()
    large = [r["group"] for r in sizes.collect() if r["count"] >= min_cluster_size]
    kept = F.when(F.col("_group").isin(large), F.col("_group"))
    return assigned.withColumn("topic_id", F.coalesce(kept, F.lit(NOISE))).drop("_group")


def cell_of(coords: Column, cell_size: float) -> Column:
    """Grid cell of a point: its coordinates in whole cell widths."""
    return F.transform(coords, lambda x: F.floor(x / F.lit(cell_size)).cast("int"))


def connected_cells(edges: DataFrame, cells: DataFrame) -> DataFrame:
    """Label every cell with the smallest cell it is connected to.

    `edges` links each cell to itself and its neighbours.
    """
    found = components(edges, "cell", "other").withColumnRenamed("node", "cell")
    return cells.select("cell").join(found, "cell", "left").select(
        "cell", F.coalesce("component", "cell").alias("label")
    )


def density_topics(
    points: DataFrame,
    dim: int,
    cell_size: float,
    min_points: int = 3,
    min_cluster_size: int = 8,
) -> DataFrame:
    """Density groups on a grid: dense cells that touch form a topic, the rest is noise.

    `coords` has `dim` elements. Points meet only through counts per cell, so copies
    and crowded regions cost one counter, not pairs. A dense cell holds at least `min_points` points; dense
    cells touch if all their coordinates differ by at most one. The topic id is a
    hash of the smallest cell of the group, so it depends on neither partitioning
    nor run.
    """
    placed = points.withColumn("cell", F.array_join(cell_of(F.col("coords"), cell_size), ","))
    dense = cut_lineage(
        placed.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") >= min_points)
    )
    offsets = F.lit([list(step) for step in itertools.product((-1, 0, 1), repeat=dim)])
    position = F.transform(F.split("cell", ","), lambda x: x.cast("int"))
    neighbours = F.transform(
        offsets, lambda step: F.array_join(F.zip_with(position, step, lambda a, b: a + b), ",")
    )
    edges = cut_lineage(
        dense.select("cell", F.explode(neighbours).alias("other")).join(
            dense.select(F.col("cell").alias("other")), "other"
        )
    )
    topics = connected_cells(edges, dense).join(dense, "cell")
    sizes = topics.groupBy("label").agg(
        F.sum("n_rows").alias("size"), F.count(F.lit(1)).alias("n_rows")
    )
    large = sizes.filter(F.col("size") >= min_cluster_size).drop("size")
    # 52 bits stay exact wherever an id ends up as a floating point number.
    topic_id = F.conv(F.substring(F.md5("label"), 1, 13), 16, 10).cast("bigint")
    lookup = attach_lookup(topics, large, ["label"], F.xxhash64("cell"), "inner").select(
        "cell", "n_rows", topic_id.alias("topic_id")
    )
    joined = attach_lookup(placed, lookup, ["cell"], F.xxhash64("segment_id"))
    return joined.withColumn("topic_id", F.coalesce("topic_id", F.lit(NOISE))).drop("cell")


def topic_shares(assigned: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Share of each topic among an ad's topical segments."""
    counts = (
        assigned.filter(F.col("topic_id") != NOISE)
        .groupBy(*within, "ad_id", "topic_id")
        .agg(F.count(F.lit(1)).alias("n_segments"))
    )
    total = F.sum("n_segments").over(Window.partitionBy(*within, "ad_id"))
    return counts.withColumn("share", F.col("n_segments") / total)


def topic_shares_wide(
    shares: DataFrame, topic_ids: Sequence[int], within: Sequence[str] = ()
) -> DataFrame:
    """One topic_share_<id> column per given topic; 0 where an ad lacks the topic.

    Topics that are not given still count in an ad's total.
    """
    keys = [*within, "ad_id"]
    wide = shares.groupBy(*keys).pivot("topic_id", list(topic_ids)).agg(F.max("share"))
    return wide.select(
        *keys,
        *[F.coalesce(F.col(f"`{t}`"), F.lit(0.0)).alias(f"topic_share_{t}") for t in topic_ids],
    )


def topic_ids(assigned: DataFrame, most: int | None = None) -> list[int]:
    """Topics that were found, noise aside, in order; with k-means at most k.

    Where their number follows from the data, `most` asks for the largest, ties by id.
    """
    found = assigned.filter(F.col("topic_id") != NOISE).groupBy("topic_id").count()
    if most is not None:
        found = found.orderBy(F.desc("count"), "topic_id").limit(most)
    return sorted(r.topic_id for r in found.collect())


def topic_summary(assigned: DataFrame) -> DataFrame:
    """Number of topics, and of unassigned and all segments."""
    topic = F.when(F.col("topic_id") != NOISE, F.col("topic_id"))
    return assigned.agg(
        F.count_distinct(topic).alias("n_topics"),
        F.count_if(F.col("topic_id") == NOISE).alias("n_noise"),
        F.count(F.lit(1)).alias("n_segments"),
    )


def topic_terms(
    assigned: DataFrame, stop_words: Sequence[str] | None = None, max_terms: int | None = None
) -> DataFrame:
    """Class-based TF-IDF score of every vocabulary term in every topic.

    The vocabulary is all terms, or if asked for the `max_terms` most frequent, ties by
    term. Text is split into terms and counted per topic before anything is shuffled, so a topic
    with most of the texts costs no more than its vocabulary.
    """
    if stop_words is None:
        stop_words = StopWordsRemover.loadDefaultStopWords("english")
    topical = assigned.filter(F.col("topic_id") != NOISE)
    # The outer form spares a filter that would split every text a second time; texts
    # without terms give a NULL term, which the stop word filter drops.
    words = topical.select("topic_id", F.explode_outer(tx.terms(F.col("text"))).alias("term"))
    counted = (
        words.filter(~F.col("term").isin(list(stop_words)))
        .groupBy("topic_id", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    vocabulary = counted.groupBy("term").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_topics_with")
    )
    if max_terms is not None:
        vocabulary = vocabulary.orderBy(F.desc("total"), "term").limit(max_terms)
    kept = counted.join(vocabulary.select("term", "n_topics_with"), "term")
    n_topics = topical.agg(F.count_distinct("topic_id").alias("n_topics"))
    topic_total = F.sum("n").over(Window.partitionBy("topic_id"))
    frequency = F.col("n") / F.greatest(topic_total, F.lit(1))
    rarity = F.ln(1 + n_topics.scalar() / F.greatest("n_topics_with", F.lit(1)))
    return kept.select("topic_id", "term", "n", (frequency * rarity).alias("weight"))


def topic_labels(weights: DataFrame, top_n: int = 6) -> DataFrame:
    """The best terms of each topic in one text, best first, ties by term.

    A topic has at most as many rows as the vocabulary has terms.
    """
    order = Window.partitionBy("topic_id").orderBy(F.desc(F.round("weight", 9)), "term")
    best = weights.withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= top_n
    )
    ordered = F.array_sort(F.collect_list(F.struct("place", "term")))
    return best.groupBy("topic_id").agg(
        F.array_join(F.transform(ordered, lambda item: item["term"]), ", ").alias("label")
    )
