"""Set-similarity join of documents: prefix filters under several token orders, then exact counts.

Two sets alike to `least` share a token among the first n - ceil(least n) + 1 tokens of each,
whatever order the tokens are in, as long as it is the same for all sets. Three orders are
used: rarest first, by hash, and by hash backwards. A pair is counted only if it shares prefix
tokens under all three, and if the sets' sizes in parts of the token space allow the overlap.

The tokens of all documents cross the network once, as packed arrays; only tokens of two
or more different sets come back, which for most documents rules a partner out. What is left
meets in cells: every rarest-first prefix token names a hub, the set with the largest share of
tokens that others have, and everything that shares such a token with a hub is in its cell.
Members are compared with the hub; members that end up outside the cell's largest group
are compared with the whole cell, block by block. Links stay inside the tasks until they
join two groups, so no pair that is no link is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends.llm.common import texts
from openends.llm.word_ids import Vocabulary, cells, chunks
from openends.operators.components import components
from openends.operators.lookup import attach_lookup
from openends.sources.shared import stored

# Words that a task holds before it sends their shingles on.
FLUSH = 1 << 20
# A token's number of sets is told apart up to this; a token that reaches it within one flush is
# known to and is not sent to be counted, but for a note, so no token fills a task.
FREQUENT = 8
# Tokens of one task that counts.
SHARD_TOKENS = 4_000_000
# Sets and tokens of one block of a cell.
BLOCK_SETS, BLOCK_TOKENS = 2_000, 4_000_000
# Parts of the token space in which two sets' sizes bound their overlap.
GROUPS = 128
# Low bits of a token: it is in the set's prefix by hash, by hash backwards, rarest first.
ASCENDING, DESCENDING, RAREST = 1, 2, 4
ORDERS = (RAREST, ASCENDING, DESCENDING)
_FLAGS = np.uint64(7)

_RUN = np.dtype([("s1", "<u8"), ("s2", "<u8"), ("count", "<u4")])
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_STEPS = np.random.default_rng(11).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Hashes whose bits all depend on all bits of the given numbers."""
    for factor in _MIX:
        x = (x ^ (x >> np.uint64(33))) * factor
    return x ^ (x >> np.uint64(33))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted 61-bit hashes of the distinct runs of `size` word hashes, three low bits free.

    Fewer words make one run, no words none.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(size, n)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total += words[i : n - size + 1 + i] * _STEPS[i]
    return np.unique(mixed(total) & ~_FLAGS)


def set_id(tokens: np.ndarray) -> tuple[int, int]:
    """96 bits of hash and 32 bits of size that stand for a set."""
    first = int(mixed(mixed(tokens + _STEPS[62]).sum(keepdims=True))[0])
    second = int(mixed(mixed(tokens ^ _STEPS[63]).sum(keepdims=True))[0])
    return first, (second & ~0xFFFFFFFF) | min(len(tokens), 0xFFFFFFFF)


def sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(ids, shingle sets) of about FLUSH words of texts at a time."""
    vocabulary, ids, numbers, held = Vocabulary(), [], [], 0

    def done():
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64, len(vocabulary))
        return np.array(ids, np.int64), [shingle_set(hashes[n], size) for n in numbers]

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), cells(batch.column("text")), strict=True):
            parts = [vocabulary.ids(chunk.lower().split()) for chunk in chunks(text)]
            ids.append(doc)
            numbers.append(parts[0] if len(parts) == 1 else np.concatenate(parts))
            held += len(numbers[-1]) + 1
            if held >= FLUSH:
                yield done()
                vocabulary, ids, numbers, held = Vocabulary(), [], [], 0
    if ids:
        yield done()


def _signed(values) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def described(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, s1, s2): number of shingles and the set's id, for every text."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in sets(batches, size):
            names = np.array([set_id(s) for s in found], np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": ids,
                    "n": np.array([len(s) for s in found], np.int64),
                    "s1": _signed(names[:, 0].copy()),
                    "s2": _signed(names[:, 1].copy()),
                }
            )

    return docs.mapInArrow(look, "doc_id bigint, n bigint, s1 bigint, s2 bigint")


def _prefix(n: np.ndarray | int, percent: int):
    """Length of the prefix in which two sets alike to `percent` must meet."""
    return n - -(-n * percent // 100) + 1


def _runs(names: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Set names and lengths of the stretches of equal numbers in `own`."""
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    runs = np.zeros(len(starts), _RUN)
    runs["s1"], runs["s2"] = names[own[starts], 0], names[own[starts], 1]
    runs["count"] = np.diff(np.r_[starts, len(own)])
    return runs


COUNT, KNOWN, NOTE = 0, 1, 2
POSTINGS = "shard int, kind int, runs binary, tokens binary"


def _pack(kind, shard, own, tokens, names, n_shards) -> list[tuple]:
    """Rows of POSTINGS: the given tokens by shard."""
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(n_shards + 1))
    rows = []
    for s in np.flatnonzero(np.diff(ends)):
        part = order[ends[s] : ends[s + 1]]
        runs = _runs(names, own[part]).tobytes() if kind != NOTE else b""
        rows.append((int(s), kind, runs, tokens[part].tobytes()))
    return rows


def postings(docs: DataFrame, size: int, percent: int, n_shards: int) -> DataFrame:
    """The tokens of all sets, packed by shard of the token; equal sets of a flush count once."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in sets(batches, size):
            different = {}
            for tokens in found:
                if len(tokens):
                    different.setdefault(set_id(tokens), tokens)
            if not different:
                continue
            names = np.array(list(different), np.uint64).reshape(-1, 2)
            flagged = []
            for tokens in different.values():
                tokens, p = tokens.copy(), _prefix(len(tokens), percent)
                tokens[:p] |= np.uint64(ASCENDING)
                tokens[-p:] |= np.uint64(DESCENDING)
                flagged.append(tokens)
            own = np.repeat(np.arange(len(flagged)), [len(t) for t in flagged])
            tokens = np.concatenate(flagged)
            plain, at, count = np.unique(tokens & ~_FLAGS, return_inverse=True, return_counts=True)
            hot, note = (count >= FREQUENT)[at], plain[count >= FREQUENT]
            by_token = ((tokens >> np.uint64(24)) % np.uint64(n_shards)).astype(np.int32)
            by_set = (names[own, 0] % np.uint64(n_shards)).astype(np.int32)
            by_note = ((note >> np.uint64(24)) % np.uint64(n_shards)).astype(np.int32)
            rows = _pack(COUNT, by_token[~hot], own[~hot], tokens[~hot], names, n_shards)
            rows += _pack(KNOWN, by_set[hot], own[hot], tokens[hot], names, n_shards)
            rows += _pack(NOTE, by_note, np.zeros(len(note), np.int64), note, names, n_shards)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _POSTING_TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "kind", "runs", "tokens"])

    return docs.mapInArrow(deal, POSTINGS)


_POSTING_TYPES = (pa.int32(), pa.int32(), pa.binary(), pa.binary())


def _unpack(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, number of the set of each token, tokens) of packed rows, equal names numbered alike."""
    runs = np.frombuffer(b"".join(frame["runs"]), _RUN)
    tokens = np.frombuffer(b"".join(frame["tokens"]), np.uint64)
    both = np.stack([runs["s1"], runs["s2"]], axis=1)
    order = np.lexsort((both[:, 1], both[:, 0]))
    new = np.r_[True, (both[order][1:] != both[order][:-1]).any(axis=1)] if len(runs) else np.zeros(0, bool)
    number = np.empty(len(runs), np.int32)
    number[order] = np.cumsum(new) - 1
    return both[order][new], np.repeat(number, runs["count"]), tokens


def shared_tokens(posted: DataFrame, n_shards: int) -> DataFrame:
    """Tokens that two or more different sets hold, with their class, packed by shard of the set.

    The class is the number of sets, FREQUENT if there are as many or more.
    """

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        names, own, tokens = _unpack(frame[frame["kind"] == COUNT])
        order = np.lexsort((own, tokens & ~_FLAGS))
        own, tokens = own[order], tokens[order]
        plain = tokens & ~_FLAGS
        fresh = np.r_[True, (plain[1:] != plain[:-1]) | (own[1:] != own[:-1])] if len(own) else np.zeros(0, bool)
        own, tokens, plain = own[fresh], tokens[fresh], plain[fresh]
        _, at, n = np.unique(plain, return_inverse=True, return_counts=True)
        n = np.minimum(n, FREQUENT)[at]
        notes = np.unique(np.frombuffer(b"".join(frame.loc[frame["kind"] == NOTE, "tokens"]), np.uint64))
        n[np.isin(plain, notes)] = FREQUENT
        kept = n > 1
        known, known_own, known_tokens = _unpack(frame[frame["kind"] == KNOWN])
        names = np.concatenate([names, known])
        own = np.concatenate([own[kept], known_own + np.int32(len(names) - len(known))])
        tokens = np.concatenate([tokens[kept], known_tokens])
        kind = np.concatenate([n[kept], np.full(len(known_own), FREQUENT)]).astype(np.uint8)
        shard = (names[own, 0] % np.uint64(n_shards)).astype(np.int32)
        order = np.lexsort((own, shard))
        own, tokens, kind, shard = own[order], tokens[order], kind[order], shard[order]
        ends = np.searchsorted(shard, np.arange(n_shards + 1))
        rows = []
        for s in np.flatnonzero(np.diff(ends)):
            part = slice(ends[s], ends[s + 1])
            runs = _runs(names, own[part]).tobytes()
            rows.append((int(s), runs, tokens[part].tobytes(), kind[part].tobytes()))
        return pd.DataFrame(rows, columns=["shard", "runs", "tokens", "class"])

    return posted.groupBy("shard").applyInPandas(count, "shard int, runs binary, tokens binary, class binary")


def open_sets(shared: DataFrame, percent: int) -> DataFrame:
    """(s1, s2, n, n_shared, tokens, keys) of the sets that have enough tokens in common with others.

    `tokens` are the shared ones, `keys` those of the rarest-first prefix. Tokens of one set only come first in
    that order, so they take their places in the prefix without being here.
    """

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        names, own, tokens = _unpack(frame)
        kind = np.frombuffer(b"".join(frame["class"]), np.uint8)
        order = np.lexsort((tokens, own))
        own, tokens, kind = own[order], tokens[order], kind[order]
        fresh = np.r_[True, (tokens[1:] != tokens[:-1]) | (own[1:] != own[:-1])] if len(own) else np.zeros(0, bool)
        own, tokens, kind = own[fresh], tokens[fresh].copy(), kind[fresh]
        ends = np.searchsorted(own, np.arange(len(names) + 1))
        n = (names[:, 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        n_shared = np.diff(ends)
        rows = []
        for s in np.flatnonzero(100 * n_shared >= percent * n):
            part = slice(ends[s], ends[s + 1])
            room = _prefix(int(n[s]), percent) - int(n[s] - n_shared[s])
            first = np.lexsort((tokens[part] & ~_FLAGS, kind[part]))[:room]
            flagged = tokens[part].copy()
            flagged[first] |= np.uint64(RAREST)
            keys = _signed(flagged[first] & ~_FLAGS)
            s1, s2 = names[s].view(np.int64)
            rows.append((s1, s2, n[s], n_shared[s], flagged.tobytes(), keys))
        return pd.DataFrame(rows, columns=["s1", "s2", "n", "n_shared", "tokens", "keys"])

    return shared.groupBy("shard").applyInPandas(
        gather, "s1 bigint, s2 bigint, n bigint, n_shared bigint, tokens binary, keys array<bigint>"
    )


class Sets:
    """Sets of one task, to compare."""

    def __init__(self, n: np.ndarray, tokens: list[bytes], percent: int):
        self.n, self.percent = n, percent
        self.flagged = [np.frombuffer(t, np.uint64) for t in tokens]
        self.parts = np.stack(
            [
                np.bincount(((t >> np.uint64(24)) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
                for t in self.flagged
            ]
        ).astype(np.int32)

    def may_link(self, one: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` whose sizes in all parts of the token space allow a link."""
        most = np.minimum(self.parts[one], self.parts[others]).sum(axis=1)
        return others[self.enough(most, one, others)]

    def enough(self, common, one, other):
        """100 |A and B| >= percent |A or B|."""
        return (100 + self.percent) * common >= self.percent * (self.n[one] + self.n[other])

    def linked(self, one: int, other: int) -> bool:
        """Whether two sets share prefix tokens under every order and are alike enough."""
        a, b = self.flagged[one], self.flagged[other]
        for order in ORDERS:
            flag = np.uint64(order)
            if not _common(a[a & flag > 0] & ~_FLAGS, b[b & flag > 0] & ~_FLAGS):
                return False
        return bool(self.enough(_common(a & ~_FLAGS, b & ~_FLAGS), one, other))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Number of values in both of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _compare(left: np.ndarray, right: np.ndarray, found: Sets, label: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets of different labels, no more than join them."""
    root = {int(x): int(x) for x in np.unique(label)}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    links = []
    for i in left:
        others = right[label[right] != label[i]]
        for j in found.may_link(i, others) if len(others) else ():
            x, y = top(int(label[i])), top(int(label[j]))
            if x != y and found.linked(i, j):
                root[max(x, y)] = min(x, y)
                links.append((i, j))
    return links


HERE, LEFT, RIGHT = 0, 1, 2


def links_of(placed: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links found at the places (doc_id, label, hub, first, second, side).

    Sets of side LEFT are compared with those of side RIGHT at the same hub and
    blocks; the links of a place join what they can with the fewest pairs.
    """
    sent = placed.join(members.select("doc_id", "n", "tokens"), "doc_id")
    size = placed.join(members.select("doc_id", "n"), "doc_id").agg(F.sum("n")).first()[0] or 0
    shards = max(12, size // SHARD_TOKENS + 1)
    shard = F.pmod(F.xxhash64("hub", "first", "second"), F.lit(shards))

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["hub", "first", "second", "doc_id"]).reset_index(drop=True)
        out = []
        for _, place in frame.groupby(["hub", "first", "second"], sort=False):
            found = Sets(place["n"].to_numpy(), list(place["tokens"]), percent)
            doc, side = place["doc_id"].to_numpy(), place["side"].to_numpy()
            pairs = _compare(
                np.flatnonzero(side == LEFT), np.flatnonzero(side == RIGHT), found, place["label"].to_numpy()
            )
            out += [(doc[i], doc[j]) for i, j in pairs]
        return pd.DataFrame(out, columns=["a", "b"])

    return sent.withColumn("shard", shard).groupBy("shard").applyInPandas(find, "a bigint, b bigint")


def _block(count: str) -> F.Column:
    return F.pmod(F.xxhash64("doc_id"), F.col(count)).cast("int")


def _blocks(sets: F.Column, tokens: F.Column) -> F.Column:
    return F.ceil(F.greatest(sets / BLOCK_SETS, tokens / BLOCK_TOKENS, F.lit(1))).cast("int")


def hub_cells(members: DataFrame) -> DataFrame:
    """(hub, doc_id, n): for every rarest-first prefix token two sets share, its hub and its sets."""
    keyed = members.select("doc_id", "n", "n_shared", F.explode("keys").alias("key"))
    rank = F.struct((F.col("n_shared") * 1_000_000 / F.col("n")).cast("bigint"), -F.col("doc_id"))
    hubs = keyed.groupBy("key").agg(
        F.max_by("doc_id", rank).alias("hub"), F.count(F.lit(1)).alias("n_rows")
    )
    met = attach_lookup(
        keyed.select("doc_id", "n", "key"), hubs.filter("n_rows > 1"), ["key"], F.xxhash64("doc_id"), "inner"
    )
    return met.select("hub", "doc_id", "n").distinct()


def hub_places(cells_: DataFrame) -> DataFrame:
    """Places where every member of a cell meets its hub."""
    others = cells_.filter("doc_id != hub")
    sizes = others.groupBy("hub").agg(
        F.count(F.lit(1)).alias("n_rows"),
        _blocks(F.count(F.lit(1)), F.sum("n")).alias("blocks"),
    )
    right = attach_lookup(others, sizes, ["hub"], F.xxhash64("doc_id"), "inner")
    right = right.select(
        "doc_id", "hub", _block("blocks").alias("first"), F.lit(0).alias("second"), F.lit(RIGHT).alias("side")
    )
    left = sizes.select(
        F.col("hub").alias("doc_id"),
        "hub",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("first"),
        F.lit(0).alias("second"),
        F.lit(LEFT).alias("side"),
    )
    return left.unionByName(right).withColumn("label", F.col("doc_id"))


def rest_places(labelled: DataFrame) -> DataFrame | None:
    """Places where all outside the largest group of a cell meet all of the cell; None if there are none."""
    groups = labelled.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("tokens"))
    largest = F.max_by(F.struct("label", "size", "tokens"), F.struct("size", "label"))
    hubs = groups.groupBy("hub").agg(
        largest.alias("top"), F.sum("size").alias("n_rows"), F.sum("tokens").alias("tokens")
    )
    hubs = hubs.filter("n_rows > top.size").select(
        "hub",
        "n_rows",
        F.col("top.label").alias("largest"),
        _blocks(F.col("n_rows") - F.col("top.size"), F.col("tokens") - F.col("top.tokens")).alias("parts"),
        _blocks(F.col("n_rows"), F.col("tokens")).alias("blocks"),
    )
    hubs = stored(hubs, "rests")
    if hubs.isEmpty():
        return None
    met = attach_lookup(labelled, hubs, ["hub"], F.xxhash64("doc_id"), "inner")
    every = {c: F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("blocks", "parts")}
    left = met.filter("label != largest").select(
        "doc_id", "label", "hub", _block("parts").alias("first"), every["blocks"].alias("second"),
        F.lit(LEFT).alias("side"),
    )
    right = met.select(
        "doc_id", "label", "hub", every["parts"].alias("first"), _block("blocks").alias("second"),
        F.lit(RIGHT).alias("side"),
    )
    return left.unionByName(right)


def jaccard_groups(
    docs: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents linked by shingles alike to `percent` or more.

    Words are split at blank and the controls tab to carriage return, A-Z in lower case; a
    document's set is its distinct runs of `size` words, or all its words if there are fewer.
    component_id is the smallest doc_id reached over links, the document itself included. Shingles are
    told apart by 61 bits of hash, sets by 96 bits and their size.

    Null texts are empty; documents without words have no shingles and are linked with nothing. Rows
    without an id are left out, of rows that repeat an id the greatest text counts, an empty
    table gives no rows; further columns, whatever their names, are not read. One text in any
    number of copies is one set; a hot token or family is split into blocks, and nothing is capped.
    """
    spark = docs.sparkSession
    plain = texts(docs, id_col, text_col)
    about = stored(described(plain, size), "described")
    total = about.agg(F.sum("n")).first()[0] or 0
    n_shards = max(12, total // SHARD_TOKENS + 1)
    counted = shared_tokens(postings(plain, size, percent, n_shards), n_shards)
    found = open_sets(counted, percent)

    copies = about.filter("n > 0").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_rows")
    )
    members = stored(
        found.join(copies.drop("n_rows"), ["s1", "s2"]).withColumnRenamed("first_id", "doc_id"), "members"
    )
    in_cells = stored(hub_cells(members), "cells")
    links = stored(links_of(hub_places(in_cells), members, percent), "links")
    labels = components(links, "a", "b")

    def labelled(rows: DataFrame, key: str, groups: DataFrame) -> DataFrame:
        named = groups.select(F.col("node").alias(key), F.col("component").alias("label"))
        return rows.join(named, key, "left").withColumn("label", F.coalesce("label", key))

    rest = rest_places(labelled(in_cells, "doc_id", labels))
    if rest is not None:
        more = stored(links_of(rest, members, percent), "links")
        if not more.isEmpty():
            labels = components(links.unionByName(more), "a", "b")

    repeated = stored(labelled(copies.filter("n_rows > 1"), "first_id", labels), "copies")
    single = labelled(
        attach_lookup(
            about,
            repeated.select("s1", "s2", "n_rows", F.col("label").alias("of_copies")),
            ["s1", "s2"],
            F.xxhash64("doc_id"),
            may_match=F.col("n") > 0,
        ),
        "doc_id",
        labels,
    )
    return single.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("of_copies", "label").alias("component_id")
    )
