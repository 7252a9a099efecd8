"""Near-duplicate groups of 64-bit fingerprints by vantage-point trees."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends.llm.common import ascii_lower, texts
from openends.llm.votes import as_hex, fingerprints
from openends.operators.components import components
from openends.sources.shared import stored

# The tree over shards is fitted on at most this many fingerprints, and on no more than
# one in SAMPLE_SHARE of all; every fingerprint is then placed by it.
SAMPLE = 20_000
SAMPLE_SHARE = 16
# Distinct fingerprints per shard at which the tree over shards stops growing.
PER_SHARD = 8_192
# Fingerprints in a leaf of the tree inside a shard, compared one by one.
LEAF = 128
# Rows of a comparison block, so memory in a task is bounded where no vantage point splits.
BLOCK = 1_024


class Split(NamedTuple):
    """Points within `reach` of the vantage point go inside, others outside."""

    vantage: int
    reach: int
    inside: int
    outside: int


def shingle_fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fingerprint bigint) from `docs` (doc_id, text).

    Words are runs of characters other than ASCII white space, A-Z in lower case. A term is
    `size` words joined by a space, repeats included; fewer words make one term, none fingerprint
    0. A bit is 1 if set in over half of the terms' XXH64 (seed 42).
    """
    words = F.array_remove(F.split(ascii_lower(F.col("text")), "[ \\t\\n\\x0B\\f\\r]+"), "")
    rows = docs.select("doc_id", words.alias("words"))
    terms = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0))),
        lambda i: F.xxhash64(F.concat_ws(" ", F.slice("words", i + 1, size))),
    )
    none = F.array().cast("array<bigint>")
    return fingerprints(
        rows.select("doc_id", F.when(F.size("words") > 0, terms).otherwise(none).alias("h")), "h"
    )


def _bits(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def _best_split(points: np.ndarray, radius: int, tries: int = 8) -> tuple[np.uint64, int] | None:
    """A vantage point of `points` and a reach that leave few points near the boundary."""
    best = None
    for vantage in points[:: max(1, len(points) // tries)][:tries]:
        apart = _bits(points, vantage)
        for reach in np.unique(np.quantile(apart, [0.35, 0.5, 0.65]).astype(np.int16)):
            inside = np.count_nonzero(apart <= reach)
            larger = max(inside, len(points) - inside)
            near = np.count_nonzero((apart <= reach) & (apart > reach - radius))
            cost = larger + near
            if larger < len(points) and (best is None or cost < best[0]):
                best = (cost, vantage, int(reach))
    return None if best is None or best[0] >= 0.95 * len(points) else best[1:]


def fit_tree(sample: np.ndarray, shards: int, radius: int) -> list[Split | int]:
    """A vantage-point tree with about `shards` leaves; node 0 is the root, leaves are shard numbers."""
    tree: list[Split | int] = []
    leaves = 0

    def grow(points: np.ndarray, wanted: int) -> int:
        nonlocal leaves
        tree.append(-1)
        at = len(tree) - 1
        found = _best_split(points, radius) if wanted > 1 and len(points) > 1 else None
        if found is None:
            tree[at], leaves = leaves, leaves + 1
            return at
        vantage, reach = found
        inner = _bits(points, vantage) <= reach
        share = max(1, min(wanted - 1, round(wanted * np.count_nonzero(inner) / len(points))))
        inside, outside = grow(points[inner], share), grow(points[~inner], wanted - share)
        tree[at] = Split(int(vantage), reach, inside, outside)
        return at

    grow(sample, shards)
    return tree


def place(
    tree: list[Split | int], points: np.ndarray, radius: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, row numbers, whether at home) for all points, by the triangle bounds of the tree.

    Every point has one home. Two points within `radius` of each other that a split separates
    lie on both sides of its boundary; the inner one then visits the outside. A point that is
    a visitor already goes to both sides wherever its ball reaches them.
    """
    waiting = [(0, np.arange(len(points)), np.ones(len(points), dtype=bool))]
    while waiting:
        at, rows, home = waiting.pop()
        node = tree[at]
        if not len(rows):
            continue
        if not isinstance(node, Split):
            yield node, rows, home
            continue
        apart = _bits(points[rows], np.uint64(node.vantage))
        inner = apart <= node.reach
        to_inside = inner | (~home & (apart <= node.reach + radius))
        to_outside = ~inner | (apart > node.reach - radius)
        waiting.append((node.inside, rows[to_inside], home[to_inside]))
        waiting.append((node.outside, rows[to_outside], (home & ~inner)[to_outside]))


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position reached from each position over links left-right."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _link(points: np.ndarray, home: np.ndarray, visit: np.ndarray, radius: int) -> tuple:
    """Links that span the groups among `home`, and of `home` with `visit`, by comparison."""
    other = np.concatenate([home, visit])
    found_a, found_b = [], []
    for start in range(0, len(home), BLOCK):
        block = home[start : start + BLOCK]
        for begin in range(0, len(other), BLOCK):
            against = other[begin : begin + BLOCK]
            i, j = np.nonzero(_bits(points[block][:, None], points[against][None, :]) <= radius)
            # Of the links in a block only a spanning forest is kept: no pairs of whole groups.
            label = _roots(len(block) + len(against), i, j + len(block))
            both = np.concatenate([block, against])
            moved = label != np.arange(len(both))
            found_a.append(both[moved])
            found_b.append(both[label[moved]])
    return np.concatenate(found_a or [home[:0]]), np.concatenate(found_b or [home[:0]])


def shard_links(points: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (row numbers) spanning the groups of one shard, found by a tree inside it.

    Rows at home are split around vantage points down to small leaves; the triangle
    bound prunes the branches that a point's ball cannot reach.
    """
    lefts, rights = [], []
    waiting = [(np.flatnonzero(home), np.flatnonzero(~home))]
    while waiting:
        own, visit = waiting.pop()
        if not len(own):
            continue
        found = _best_split(points[own], radius) if len(own) > LEAF else None
        if found is None:
            left, right = _link(points, own, visit, radius)
            lefts.append(left)
            rights.append(right)
            continue
        vantage, reach = found
        apart, away = _bits(points[own], vantage), _bits(points[visit], vantage)
        near = own[(apart <= reach) & (apart > reach - radius)]
        waiting.append((own[apart <= reach], visit[away <= reach + radius]))
        waiting.append(
            (own[apart > reach], np.concatenate([near, visit[away > reach - radius]]))
        )
    left, right = np.concatenate(lefts), np.concatenate(rights)
    label = _roots(len(points), left, right)
    moved = np.flatnonzero(label != np.arange(len(points)))
    return moved, label[moved]


def near_groups(distinct: DataFrame, radius: int = 2, per_shard: int = PER_SHARD) -> DataFrame:
    """(node, component) of distinct fingerprints within `radius` bits of another one.

    `distinct` has fingerprint (bigint) and node, a number that stands for it. Fingerprints
    are dealt to the shards of a vantage-point tree; those near a boundary are sent to every
    shard their ball overlaps. Each shard returns at most one link per row.
    """
    total = distinct.count()
    keep_one_in = max(SAMPLE_SHARE, math.ceil(total / SAMPLE))
    order = F.xxhash64(F.col("fingerprint"), F.lit(1))
    chosen = distinct.filter(F.pmod(order, F.lit(keep_one_in)) == 0).select("fingerprint")
    sample = np.sort(np.array([r[0] for r in chosen.collect()], dtype=np.int64)).view(np.uint64)
    sample = sample[np.random.default_rng(0).permutation(len(sample))]
    tree = fit_tree(sample, math.ceil(total / per_shard), radius)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = frame["fingerprint"].to_numpy(np.int64).view(np.uint64)
            for shard, rows, home in place(tree, points, radius):
                yield frame.iloc[rows].assign(shard=shard, home=home)

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        points = frame["fingerprint"].to_numpy(np.int64).view(np.uint64)
        node = frame["node"].to_numpy(np.int64)
        left, right = shard_links(points, frame["home"].to_numpy(bool), radius)
        return pd.DataFrame({"a": node[left], "b": node[right]})

    dealt = distinct.select("fingerprint", "node").mapInPandas(
        deal, "fingerprint bigint, node bigint, shard int, home boolean"
    )
    links = dealt.groupBy("shard").applyInPandas(link, "a bigint, b bigint")
    return components(links, "a", "b")


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = 2,
    size: int = 3,
    per_shard: int = PER_SHARD,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    Fingerprints link at `radius` or fewer differing bits; component_id is the smallest
    doc_id reached over links, the document itself included. Copies are one fingerprint
    before anything is compared.

    Null texts are empty and, like all texts without words, have fingerprint 0, which links
    like any other. Rows without an id are left out, rows that repeat an id count
    once, an empty table gives no rows.
    """
    prints = stored(shingle_fingerprints(texts(docs, id_col, text_col), size), "fingerprints")
    distinct = stored(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("node")), "distinct"
    )
    groups = near_groups(distinct, radius, per_shard)
    named = stored(
        distinct.join(groups, "node", "left").select(
            "fingerprint", F.coalesce("component", "node").alias("component_id")
        ),
        "named",
    )
    return prints.join(named, "fingerprint").select(
        "doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )

