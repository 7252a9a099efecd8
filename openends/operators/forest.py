"""Random forests of many training tables at once: one plan instead of a fit per table and fold.

The unit of work is a part of the trees of one table and fold. Trees are grown level by level, many at a time, on
all rows of the training part; the votes on the rows held out leave the task, not the trees. A task holds the
inputs of its table, one row per ad, and nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openends.sources.shared import stored

# Rows of bootstraps that are cut together at most; one tree at least. No row is left out.
MAX_SAMPLE = 65_536
# Rows times trees for which a task of its own pays, and rows of a block in which a table travels.
TASK_ROWS, BLOCK = 200_000, 65_536
# Tasks of all tables and folds: a table is copied once per task, so many tables get few parts each.
TASKS = 192
# Trees of a stored forest that are read together.
TREES = 50
# Tasks that the parts are dealt to. The number is given, so that small but slow parts are not merged.
PARTITIONS = 256

NODE = np.dtype([("feature", "<i4"), ("left", "<i4"), ("right", "<i4"), ("threshold", "<f8")])


def best_cuts(
    node: np.ndarray, code: np.ndarray, stats: np.ndarray, n_nodes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the best cut of one input: (score, code left of it, code right of it), score -inf if there is none.

    `stats` holds weighted values, a line per class or one for a number, and the weight. A cut scores
    the sum of squared sums over weight of its sides: what it takes from Gini's impurity, or from the variance.
    """
    rows, codes = len(node).bit_length(), int(code.max()).bit_length()
    if rows + codes + n_nodes.bit_length() < 63:
        # Node, code and place in one number: sorting numbers is several times faster than sorting places.
        key = (node.astype(np.int64) << (rows + codes)) | (code.astype(np.int64) << rows) | np.arange(len(node))
        key.sort()
        order = key & ((1 << rows) - 1)
    else:
        order = np.lexsort((code, node))
    node, code = node[order], code[order]
    score, low, high = np.full(n_nodes, -np.inf), np.full(n_nodes, -1), np.full(n_nodes, -1)
    same = node[1:] == node[:-1]
    cut = np.flatnonzero(same & (code[1:] > code[:-1]))
    if not len(cut):
        return score, low, high
    last = np.append(np.flatnonzero(~same), len(node) - 1)
    run = np.cumsum(np.concatenate([[0], ~same]))[cut]
    left_squares = right_squares = 0.0
    for number, line in enumerate(stats):
        up_to = np.cumsum(line[order])
        before = np.concatenate([[0.0], up_to[last[:-1]]])
        left = up_to[cut] - before[run]
        right = (up_to[last] - before)[run] - left
        if number < len(stats) - 1:
            left_squares, right_squares = left_squares + left * left, right_squares + right * right
    found = left_squares / left + right_squares / right
    begins = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    most = np.repeat(np.maximum.reduceat(found, begins), np.diff(np.append(begins, len(cut))))
    hits = np.flatnonzero(found == most)
    best = hits[np.unique(run[hits], return_index=True)[1]]
    at = node[cut[best]]
    score[at], low[at], high[at] = found[best], code[cut[best]], code[cut[best] + 1]
    return score, low, high


def _codes(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Every input as the places of its values in their order, and the values."""
    codes, values = np.empty(x.shape, np.int32), []
    for feature in range(x.shape[1]):
        found, codes[:, feature] = np.unique(x[:, feature], return_inverse=True)
        values.append(found)
    return codes, values


def _thresholds(values: list[np.ndarray], feature: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    flat = np.concatenate(values)
    start = np.cumsum([0] + [len(v) for v in values])[feature]
    left, right = flat[start + low], flat[start + high]
    middle = (left + right) / 2
    # Two neighbours among the floating point numbers have no number between them.
    return np.where((left <= middle) & (middle < right), middle, left)


def best_split(x: np.ndarray, weight: np.ndarray) -> tuple[float, float] | None:
    """(weighted impurity left over, threshold) of the best cut of one input; None if all values are equal.

    `weight` holds the weight of every row in the column of its class; impurity is Gini's.
    """
    codes, values = _codes(x[:, None])
    stats = np.vstack([weight.T, weight.sum(axis=1)])
    score, low, high = best_cuts(np.zeros(len(x), np.int64), codes[:, 0], stats, 1)
    if low[0] < 0:
        return None
    return float(weight.sum() - score[0]), float(_thresholds(values, np.zeros(1, int), low, high)[0])


def grow_trees(
    codes: np.ndarray,
    values: list[np.ndarray],
    target: np.ndarray,
    stats: np.ndarray,
    drawn: np.ndarray,
    rng: np.random.Generator,
    per_node: int,
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(nodes, values of the nodes, gain per input) of trees grown until their leaves are pure or cannot be cut.

    `drawn` tells per tree how often each row is in its bootstrap, `target` what a pure leaf has one of. Every node looks at
    `per_node` inputs in random order, and at more only while none of them can be cut.
    """
    n_inputs = codes.shape[1]
    node, row = np.nonzero(drawn)
    rows = stats[:, row] * drawn[node, row]
    tree_of, levels, start = np.arange(len(drawn)), [], 0
    gains = np.zeros((len(drawn), n_inputs))
    while len(tree_of):
        n = len(tree_of)
        begins = np.searchsorted(node, np.arange(n))
        total = np.add.reduceat(rows, begins, axis=1)
        mixed = np.minimum.reduceat(target[row], begins) < np.maximum.reduceat(target[row], begins)
        kept = mixed[node]
        node, row, rows = node[kept], row[kept], rows[:, kept]
        tried = rng.random((n, n_inputs)).argsort(axis=1)
        score, feature, low, high = np.full(n, -np.inf), np.full(n, -1), np.full(n, -1), np.full(n, -1)
        for slot in range(n_inputs):
            looking = mixed if slot < per_node else mixed & (feature < 0)
            if not looking.any():
                break
            some = slice(None) if slot < per_node else np.flatnonzero(looking[node])
            of, named = node[some], tried[:, slot]
            found = best_cuts(of, codes[row[some], named[of]], rows[:, some], n)
            better = found[0] > score
            for have, new in zip((score, feature, low, high), (found[0], named, *found[1:]), strict=True):
                have[better] = new[better]
        cut = np.flatnonzero(feature >= 0)
        here = (total[:-1, cut] ** 2).sum(axis=0) / total[-1, cut]
        np.add.at(gains, (tree_of[cut], feature[cut]), score[cut] - here)
        left = np.full(n, -1)
        left[cut] = start + n + 2 * np.arange(len(cut))
        levels.append((tree_of, feature, low, high, left, (total[:-1] / total[-1]).T))
        if (feature[mixed] < 0).any():
            kept = feature[node] >= 0
            node, row, rows = node[kept], row[kept], rows[:, kept]
        node = left[node] - start - n + (codes[row, feature[node]] > low[node])
        order = np.argsort(node, kind="stable")
        node, row, rows = node[order], row[order], rows[:, order]
        tree_of, start = np.repeat(tree_of[cut], 2), start + n
    tree, feature, low, high, left, shares = (np.concatenate(part) for part in zip(*levels, strict=True))
    order = np.argsort(tree, kind="stable")
    ends = np.cumsum(np.bincount(tree, minlength=len(drawn)))
    first = np.concatenate([[0], ends[:-1]])
    place = np.empty(len(tree), np.int64)
    place[order] = np.arange(len(tree)) - first[tree[order]]
    inner = feature >= 0
    packed = np.zeros(len(tree), NODE)
    packed["feature"], packed["left"], packed["right"] = feature, -1, -1
    packed["left"][inner] = place[left[inner]]
    packed["right"][inner] = place[left[inner]] + 1
    packed["threshold"][inner] = _thresholds(values, feature[inner], low[inner], high[inner])
    return [(packed[order[a:b]], shares[order[a:b]], gains[t]) for t, (a, b) in enumerate(zip(first, ends, strict=True))]


def grow(
    x: np.ndarray, weight: np.ndarray, rng: np.random.Generator, per_node: int
) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, class shares) of one tree on rows whose weights stand in the columns of their classes."""
    stats = np.vstack([weight.T, weight.sum(axis=1)])
    ones = np.ones((1, len(x)))
    return grow_trees(*_codes(x), weight.argmax(axis=1), stats, ones, rng, per_node)[0][:2]


def votes(nodes: np.ndarray, shares: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values of the leaf that every row reaches."""
    at = np.zeros(len(x), np.int64)
    going = np.flatnonzero(nodes["feature"][at] >= 0)
    while len(going):
        node = nodes[at[going]]
        low = x[going, node["feature"]] <= node["threshold"]
        at[going] = np.where(low, node["left"], node["right"])
        going = going[nodes["feature"][at[going]] >= 0]
    return shares[at]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _forest(
    x: np.ndarray, label: np.ndarray, n_classes: int, trees: range, seed: Sequence[int]
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(tree, nodes, values, gain per input) of trees on bootstraps of the rows; no classes: a forest of a number.

    Classes weigh the same and a node looks at the root of the number of inputs; for a number, at all of them.
    """
    per_node = int(np.ceil(x.shape[1] ** 0.5)) if n_classes else x.shape[1]
    centre = 0.0
    if n_classes:
        count = np.bincount(label.astype(int), minlength=n_classes)
        balance = (len(x) / ((count > 0).sum() * np.maximum(count, 1)))[label.astype(int)]
        stats = np.zeros((n_classes + 1, len(x)))
        stats[label.astype(int), np.arange(len(x))] = stats[-1] = balance
    else:
        centre = float(label.mean())
        stats = np.vstack([label - centre, np.ones(len(x))])
    codes, values = _codes(x)
    together = max(1, MAX_SAMPLE // len(x))
    for start in range(trees.start, trees.stop, together):
        batch = range(start, min(trees.stop, start + together))
        rng = np.random.default_rng([*seed, start])
        drawn = np.stack([np.bincount(rng.integers(0, len(x), len(x)), minlength=len(x)) for _ in batch])
        grown = grow_trees(codes, values, label, stats, drawn, rng, per_node)
        for tree, (nodes, shares, gain) in zip(batch, grown, strict=True):
            yield tree, nodes, shares + centre, gain


def _packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The tables as blocks of their rows: keys, number of rows, folds, and the rows' ids and numbers as bytes."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.collect_set("fold").alias("folds"))
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("bigint")
    blocks = rows.join(sizes.select(*keys, n_blocks.alias("n_blocks")), keys).withColumn(
        "block", F.pmod(F.xxhash64("ad_id"), F.col("n_blocks")).cast("int")
    )

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        numbers = {c: [frame[c].to_numpy(np.float64).tobytes()] for c in ("label", "fold")}
        whole = {"ids": [frame["ad_id"].tolist()], **numbers, "x": [_matrix(frame["x"]).tobytes()]}
        return pd.DataFrame({**{k: [int(frame[k].iloc[0])] for k in keys}, **whole})

    ints = ", ".join(f"{k} int" for k in keys)
    fields = f"{ints}, ids array<string>, label binary, fold binary, x binary"
    return stored(blocks.groupBy(*keys, "block").applyInPandas(pack, fields).join(sizes, keys), "blocks")


def _dealt(blocks: DataFrame, keys: list[str], held: Column, n_trees: int) -> DataFrame:
    """A copy of every block for each fold held out and part of the trees."""
    each = blocks.withColumn("held", held)
    most = min(n_trees, max(1, TASKS // max(1, each.select(*keys, "held").distinct().count())))
    parts = F.least(F.lit(most), F.ceil(F.col("n") * n_trees / TASK_ROWS)).cast("int")
    return (
        each
        .withColumn("parts", parts)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .repartition(PARTITIONS, *keys, "held", "part")
    )


def _unpacked(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, label, fold, x) of all rows of a table, in the order of their ids."""
    ids = np.concatenate([np.asarray(part, dtype=object) for part in frame["ids"]])
    label, fold, x = (np.concatenate([np.frombuffer(b) for b in frame[c]]) for c in ("label", "fold", "x"))
    order = np.argsort(ids, kind="stable")
    return ids[order], label[order], fold[order].astype(int), x.reshape(len(ids), -1)[order]


def _trees_of(frame: pd.DataFrame, n_trees: int) -> range:
    part, parts = int(frame["part"].iloc[0]), int(frame["parts"].iloc[0])
    return range(part * n_trees // parts, (part + 1) * n_trees // parts)


def _predicted(votes_of: Column, n_classes: int, n_trees: int) -> Column:
    """The class with the most votes, ties to the smaller label, or the mean number; parts are added in their order."""
    parts = F.array_sort(votes_of)

    def total(place: int) -> Column:
        return F.aggregate(parts, F.lit(0.0), lambda so_far, p: so_far + p["votes"][place])

    sums = [total(c) for c in range(max(1, n_classes))]
    if not n_classes:
        return sums[0] / n_trees
    rounded = F.array(*[F.round(s, 9) for s in sums])
    return (F.array_position(rounded, F.array_max(rounded)) - 1).cast("double")


def cross_validate(
    rows: DataFrame, keys: Sequence[str], n_classes: int, n_trees: int = 300, seed: int = 42
) -> DataFrame:
    """(keys, fold, ad_id, label, prediction): forests of all tables, each fold scored by trees of the others.

    `rows` holds (keys, ad_id, label, fold, x): one table per value of the integer keys, labels 0 to n_classes - 1, or
    any number if there are no classes, and inputs as an array without nulls. Classes weigh the same in every training part; trees are
    grown on bootstraps of all its rows, look at sqrt(inputs) inputs per node (all, for a number) and vote by class
    shares, ties to the smaller label. A tree depends on the seed, its table and fold and number only, not on the other
    tables or on partitions. A fold whose training part is empty has no rows.
    """
    keys = list(keys)

    def score(frame: pd.DataFrame) -> pd.DataFrame:
        ids, label, fold, x = _unpacked(frame)
        held, part = int(frame["held"].iloc[0]), int(frame["part"].iloc[0])
        known, asked = fold != held, fold == held
        table = [int(frame[k].iloc[0]) for k in keys]
        total = np.zeros((asked.sum(), max(1, n_classes)))
        if known.any():
            for _, nodes, shares, _ in _forest(
                x[known], label[known], n_classes, _trees_of(frame, n_trees), [seed, *table, held]
            ):
                total += votes(nodes, shares, x[asked])
        else:
            asked = np.zeros_like(asked)
        out = pd.DataFrame({"ad_id": ids[asked], "label": label[asked], "votes": pd.Series(list(total[: asked.sum()]), dtype=object)})
        return out.assign(fold=held, part=part, **dict(zip(keys, table, strict=True)))

    ints = ", ".join(f"{k} int" for k in keys)
    fields = f"{ints}, fold int, part int, ad_id string, label double, votes array<double>"
    dealt = _dealt(_packed(rows, keys), keys, F.explode("folds"), n_trees)
    voted = stored(dealt.groupBy(*keys, "held", "part").applyInPandas(score, fields), "votes")
    each = F.collect_list(F.struct("part", "votes"))
    return voted.groupBy(*keys, "fold", "ad_id").agg(
        F.first("label").alias("label"), _predicted(each, n_classes, n_trees).alias("prediction")
    )


@dataclass(frozen=True)
class ForestModel:
    """A fitted forest; its trees are rows of a table in the shared folder."""

    trees: DataFrame
    n_classes: int
    n_trees: int

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802, as Spark's models name it
        """Share of every input in what the cuts take from the impurity; trees weigh the same."""
        total = F.aggregate("gain", F.lit(0.0), lambda s, g: s + g)
        share = F.transform("gain", lambda g: F.when(total > 0, g / total).otherwise(0.0))
        means = self.trees.select(F.posexplode(share)).groupBy("pos").agg(F.avg("col").alias("mean"))
        found = np.array([r["mean"] for r in means.orderBy("pos").collect()])
        return DenseVector(found / found.sum() if found.sum() else found)

    def transform(self, rows: DataFrame) -> DataFrame:
        """`rows` with the prediction for their vector `features`; blocks of rows meet parts of the trees."""
        n_classes = self.n_classes
        rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "asked")
        n_blocks = max(1, -(-rows.count() // BLOCK))
        block = F.pmod(F.xxhash64("_row"), F.lit(n_blocks)).cast("int")
        part = F.floor(F.col("tree") / TREES).cast("int")
        asked = rows.select("_row", vector_to_array("features").alias("x"), block.alias("block")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.lit((self.n_trees - 1) // TREES)))
        )
        forest = self.trees.withColumn("part", part).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
        )

        def vote(known: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
            if not len(known):
                return known[["_row", "part"]].assign(votes=pd.Series(dtype=object))
            x, total = _matrix(known["x"]), 0.0
            for _, tree in forest.sort_values("tree").iterrows():
                shares = np.frombuffer(tree["shares"]).reshape(-1, max(1, n_classes))
                total = total + votes(np.frombuffer(tree["nodes"], NODE), shares, x)
            return known[["_row", "part"]].assign(votes=list(total))

        place = ["block", "part"]
        both = asked.repartition(PARTITIONS, *place).groupBy(*place).cogroup(
            forest.repartition(PARTITIONS, *place).groupBy(*place)
        )
        voted = both.applyInPandas(vote, "_row bigint, part int, votes array<double>")
        each = F.collect_list(F.struct("part", "votes"))
        found = voted.groupBy("_row").agg(_predicted(each, n_classes, self.n_trees).alias("prediction"))
        return rows.join(found, "_row").drop("_row")


def fit(rows: DataFrame, n_classes: int, n_trees: int = 300, seed: int = 42) -> ForestModel:
    """The forest of all rows (ad_id, label, x); no classes: of a number."""

    def grown(frame: pd.DataFrame) -> pd.DataFrame:
        _, label, _, x = _unpacked(frame)
        found = _forest(x, label, n_classes, _trees_of(frame, n_trees), [seed])
        return pd.DataFrame(
            [(tree, nodes.tobytes(), shares.tobytes(), gain) for tree, nodes, shares, gain in found],
            columns=["tree", "nodes", "shares", "gain"],
        )

    blocks = _packed(rows.withColumns({"fold": F.lit(0), "table": F.lit(0)}), ["table"])
    dealt = _dealt(blocks, ["table"], F.lit(-1), n_trees)
    fields = "tree int, nodes binary, shares binary, gain array<double>"
    return ForestModel(stored(dealt.groupBy("held", "part").applyInPandas(grown, fields), "trees"), n_classes, n_trees)
