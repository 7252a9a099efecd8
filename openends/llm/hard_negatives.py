"""Hard negatives by an inverted multi-index: two codebooks, one for each half of a vector.

A row's cell is the pair of its nearest centres. What an anchor scores with any row of a cell is at
most the sum of two half-scores: the centre's inner product with the anchor's half, plus the half's
length times the radius of the centre, the farthest distance of any row from it. A heap over the two
sorted lists of half-scores visits cells by falling sums, and stops where no cell left can change
the answer. Anchors first visit the cells of about SEED_ROWS rows; what they find there says how far
they must go on. All rows are indexed, and results are exact whatever the codebooks are.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends.llm.common import hashed_sample, unique
from openends.sources.shared import stored

# Rows from which the codebooks are learned, on the driver; all rows are indexed.
SAMPLE = 20_000
ROUNDS = 10
# Rows of a cell to aim at, and the most centres of a codebook.
CELL_ROWS, CENTRES = 1_000, 64
# Rows in the cells that an anchor visits first.
SEED_ROWS = 4_000
# Rows and anchors that meet at a time.
BLOCK_ROWS, BLOCK_ANCHORS = 20_000, 1_000
# Bounds are sums of floating point numbers; this much is added.
SLACK = 1e-6

FOUND = "anchor_id bigint, window int, vec_id bigint, score bigint"


def codebook(points: np.ndarray, k: int) -> np.ndarray:
    """Centres of `points` after a fixed number of k-means rounds from points spread by distance."""
    centres = points[:1]
    near = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and near.max() > 0:
        centres = np.concatenate([centres, points[[near.argmax()]]])
        near = np.minimum(near, ((points - centres[-1]) ** 2).sum(axis=1))
    for _ in range(ROUNDS):
        code = nearest(points, centres)[0]
        count = np.bincount(code, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, code, points)
        filled = count > 0
        centres[filled] = total[filled] / count[filled, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of every point and the distance to it."""
    square = (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)
    code = square.argmin(axis=1)
    return code, np.sqrt(((points - centres[code]) ** 2).sum(axis=1))


def vectors(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of vectors of whole numbers."""
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1]
    if most < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


@dataclass(frozen=True)
class Index:
    """Codebooks, radii and cell sizes: at most CENTRES squared numbers, whatever the rows."""

    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray

    def halves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle = self.centres[0].shape[1]
        return points[:, :middle].astype(np.float64), points[:, middle:].astype(np.float64)

    def cells(self, anchor: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, cell, rows) of the filled cells, by falling bound."""
        bounds = [
            centres @ half[0] + np.linalg.norm(half[0]) * radii
            for half, centres, radii in zip(self.halves(anchor[None]), self.centres, self.radii, strict=True)
        ]
        first, second = (np.argsort(-b, kind="stable") for b in bounds)
        a, b = bounds[0][first], bounds[1][second]
        slack = SLACK * (1 + np.abs(a).max() + np.abs(b).max())
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            rows = int(self.sizes[first[i], second[j]])
            if rows:
                yield -bound + slack, int(first[i]) * len(b) + int(second[j]), rows
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))

    def visits(self, anchor: np.ndarray, least: float | None) -> list[int]:
        """Cells to visit: the first ones, or, with a score, those after them that may reach it."""
        out, seen = [], 0
        for bound, cell, rows in self.cells(anchor):
            first = seen < SEED_ROWS
            seen += rows
            if least is None:
                if not first:
                    break
                out.append(cell)
            elif not first:
                if bound < least:
                    break
                out.append(cell)
        return out


def build_index(rows: DataFrame, dim: int) -> tuple[DataFrame, Index]:
    """Rows (vec_id, label, vector) with their cell, stored, and the index over them."""
    n, middle = rows.count(), dim // 2
    k = max(1, min(CENTRES, round((n / CELL_ROWS) ** 0.5)))
    chosen = hashed_sample(rows.select("vec_id", "vector"), "vec_id", SAMPLE).toPandas()
    sample = vectors(chosen.sort_values("vec_id")["vector"]).astype(np.float64)
    if not len(sample):  # the few rows there are had large hashes
        sample = vectors(rows.select("vector").limit(1).toPandas()["vector"]).astype(np.float64)
    if not len(sample):
        sample = np.zeros((1, dim))
    centres = (codebook(sample[:, :middle], k), codebook(sample[:, middle:], k))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = vectors(frame["vector"]).astype(np.float64).reshape(-1, dim)
            (c1, d1), (c2, d2) = nearest(points[:, :middle], centres[0]), nearest(points[:, middle:], centres[1])
            yield frame.assign(c1=c1, c2=c2, d1=d1, d2=d2)

    kinds = "vec_id bigint, label bigint, vector array<bigint>, c1 int, c2 int, d1 double, d2 double"
    placed = stored(rows.select("vec_id", "label", "vector").mapInPandas(place, kinds), "indexed")
    sizes = np.zeros((len(centres[0]), len(centres[1])), np.int64)
    radii = np.zeros(len(centres[0])), np.zeros(len(centres[1]))
    cells = placed.groupBy("c1", "c2").agg(
        F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")
    )
    for c1, c2, count, d1, d2 in cells.collect():
        sizes[c1, c2] = count
        radii[0][c1], radii[1][c2] = max(radii[0][c1], d1), max(radii[1][c2], d2)
    cell = (F.col("c1") * len(centres[1]) + F.col("c2")).cast("int")
    return placed.select("vec_id", "label", "vector", cell.alias("cell")), Index(centres, radii, sizes)


def best(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Positions of the `count` highest scores, smaller ids first among equals."""
    if len(score) > count:
        kept = np.flatnonzero(score >= np.partition(score, len(score) - count)[len(score) - count])
    else:
        kept = np.arange(len(score))
    return kept[np.lexsort((ids[kept], -score[kept]))[:count]]


# What an anchor wants from a row of scores: (window, positions that may be in it).
Windows = Callable[[pd.Series, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray]]]


def same_label(anchor, ids, labels, scores) -> Iterator[tuple[int, np.ndarray]]:
    yield 0, np.flatnonzero((labels == anchor["label"]) & (ids != anchor["vec_id"]))


def windows(least: int, most: int) -> Windows:
    """Rows of other labels whose score is `least` to `most` percent of a positive's."""

    def other_label(anchor, ids, labels, scores):
        other = labels != anchor["label"]
        for window, score in enumerate(anchor["positives"]):
            yield window, np.flatnonzero(other & (100 * scores >= least * score) & (100 * scores <= most * score))

    return other_label


def scan(rows: DataFrame, anchors: DataFrame, index: Index, wanted: Windows, count: int, seed: bool) -> DataFrame:
    """FOUND: for every anchor and window the best `count` rows of each block it visits.

    `anchors` have vec_id, label, vector, positives, and least, the score below which rows do not
    matter; with `seed` the first cells are visited, else those after them.
    """
    spark = rows.sparkSession

    def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["cells"] = [
                index.visits(np.asarray(v), None if seed else least)
                for v, least in zip(frame["vector"], frame["least"], strict=True)
            ]
            yield frame

    kinds = (
        "vec_id bigint, label bigint, vector array<bigint>, positives array<bigint>, least double, cells array<int>"
    )
    columns = ["vec_id", "label", "vector", "positives", "least"]
    visits = anchors.select(columns).mapInPandas(plan, kinds).withColumn("cell", F.explode("cells")).drop("cells")
    visits = stored(visits, "visits")
    loads = visits.groupBy("cell").count().collect()  # at most CENTRES squared rows
    # Numbers of blocks of anchors and of rows of every visited cell.
    blocks = [
        (int(c), -(-int(n) // BLOCK_ANCHORS), -(-int(index.sizes.ravel()[c]) // BLOCK_ROWS)) for c, n in loads
    ]
    table = spark.createDataFrame(blocks, "cell int, anchor_blocks int, row_blocks int")

    def spread(side: DataFrame, own: str, other: str, name: str) -> DataFrame:
        met = side.join(F.broadcast(table), "cell")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        mine = F.pmod(F.xxhash64("vec_id", F.lit(name)), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block")
        return met.select("*", mine, every).drop("anchor_blocks", "row_blocks")

    left = spread(visits, "anchor", "row", "visit").withColumn("anchor", F.lit(True))
    right = spread(rows, "row", "anchor", "row").select(
        "*", F.lit(None).cast("array<bigint>").alias("positives"), F.lit(0.0).alias("least"), F.lit(False).alias("anchor")
    )
    place = ["cell", "anchor_block", "row_block"]
    moved = sum(a * r * (BLOCK_ANCHORS + BLOCK_ROWS) for _, a, r in blocks)
    shards = max(12, min(sum(a * r for _, a, r in blocks), moved // (8 * BLOCK_ROWS)))
    both = left.unionByName(right).withColumn("shard", F.pmod(F.xxhash64(*place), F.lit(shards)))

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in frame.groupby(place, sort=False):
            is_anchor = part["anchor"].to_numpy()
            held, known = part[~is_anchor], part[is_anchor]
            if not len(held) or not len(known):
                continue
            ids, labels = held["vec_id"].to_numpy(), held["label"].to_numpy()
            scores = inner_products(vectors(known["vector"]), vectors(held["vector"]))
            for row, (_, anchor) in zip(scores, known.iterrows(), strict=True):
                for window, fit in wanted(anchor, ids, labels, row):
                    at = fit[best(row[fit], ids[fit], count)]
                    out.append(
                        pd.DataFrame(
                            {"anchor_id": anchor["vec_id"], "window": window, "vec_id": ids[at], "score": row[at]}
                        )
                    )
        return pd.concat(out) if out else pd.DataFrame(columns=["anchor_id", "window", "vec_id", "score"])

    return stored(both.groupBy("shard").applyInPandas(meet, FOUND), "found")


def top(found: DataFrame, count: int) -> DataFrame:
    """(anchor_id, window, best): the best `count` rows of every window, as an array in order."""
    # Score and id in one key: higher scores first, then smaller ids.
    entry = F.struct((-F.col("score")).alias("low"), "vec_id")
    ranked = found.groupBy("anchor_id", "window").agg(F.array_sort(F.collect_list(entry)).alias("best"))
    return ranked.withColumn("best", F.slice("best", 1, count))


def hard_negatives(
    rows: DataFrame,
    anchors: F.Column,
    dim: int = 64,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale x), a score is the inner product of these numbers with the anchor's;
    higher scores come first, then smaller ids. An anchor's positives are its first rows
    of the same label; for each of them come the first rows of other labels whose score
    is `least` to `most` percent of the positive's. A positive of negative score has no such rows.
    `anchors` is a condition on the id column.

    Rows without id, label or vector, of another length than `dim`, or with a component that
    is null or not finite take no part; of rows that repeat an id the greatest stays (by label, then vector). An
    empty table, or one without anchors, gives no rows; further columns are not read. Scores must fit 64 bits.
    """
    table = rows.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        anchors.alias("is_anchor"),
    )
    table = table.filter(F.col("label").isNotNull() & (F.size("vector") == dim))
    # A null component makes the condition null, and such rows are left out too.
    table = table.filter(F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    table = unique(table, "vec_id").withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale)))
    marked = stored(table, "vectors")
    coded, index = build_index(marked, dim)
    asked = marked.filter("is_anchor").select("vec_id", "label", "vector")
    none = F.array().cast("array<bigint>")
    asked = asked.withColumns({"positives": none, "least": F.lit(float("-inf"))})

    def both(wanted: Windows, count: int, of: DataFrame, bound: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Best rows of all windows: a first look, then all cells that can still change it."""
        seen = scan(coded, of, index, wanted, count, seed=True)
        rest = scan(coded, bound(top(seen, count)), index, wanted, count, seed=False)
        return stored(top(seen.unionByName(rest), count), "best")

    def positive_bound(best_: DataFrame) -> DataFrame:
        """All of the anchor's label matter until there are enough, then only better ones."""
        full = best_.filter(F.size("best") == positives)
        limit = full.select(
            F.col("anchor_id").alias("vec_id"), (-F.element_at("best", -1)["low"]).cast("double").alias("limit")
        )
        return asked.join(limit, "vec_id", "left").withColumn("least", F.coalesce("limit", "least")).drop("limit")

    found = both(same_label, positives, asked, positive_bound).filter("size(best) > 0")
    scores = F.transform("best", lambda x: -x["low"])
    looking = asked.drop("positives").join(
        found.select(F.col("anchor_id").alias("vec_id"), scores.alias("positives")), "vec_id"
    )
    looking = stored(looking.filter(F.element_at("positives", 1) >= 0), "looking")

    def negative_bound(best_: DataFrame) -> DataFrame:
        """For every positive the last of its rows, or the least score that still fits."""
        limits = best_.filter(F.size("best") == negatives).select(
            F.col("anchor_id").alias("vec_id"), "window", (-F.element_at("best", -1)["low"]).alias("last")
        )
        each = looking.select("vec_id", F.posexplode("positives").alias("window", "score")).filter("score >= 0")
        low = F.coalesce(F.col("last").cast("double"), F.ceil(F.col("score") * least / 100).cast("double"))
        limit = each.join(limits, ["vec_id", "window"], "left").groupBy("vec_id").agg(F.min(low).alias("limit"))
        return looking.drop("least").join(limit.withColumnRenamed("limit", "least"), "vec_id")

    near = both(windows(least, most), negatives, looking, negative_bound)
    given = found.select("anchor_id", F.posexplode("best").alias("window", "positive"))
    chosen = near.select("anchor_id", "window", F.posexplode("best").alias("at", "negative"))
    return given.join(chosen, ["anchor_id", "window"]).select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("negative.vec_id").alias("negative_id"),
        (-F.col("positive.low")).alias("positive_score"),
        (-F.col("negative.low")).alias("negative_score"),
    )
