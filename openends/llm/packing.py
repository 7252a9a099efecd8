"""Packing documents into sequences: dominance reduction, then best fit, by counts per length.

Lengths are at most the capacity, so the whole instance is a histogram of bounded size.
The plan for it is made on the driver; the documents themselves are only ranked within
their length and looked up in the plan.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from openends.llm.bpe import encoder, packed_ids
from openends.llm.common import texts
from openends.sources.shared import stored

END = 0
# Pieces of one length are numbered in so many parts at least, and in more where a part
# would exceed ROWS_PER_PART, since a third of all pieces may have one length.
PARTS = 256
ROWS_PER_PART = 1_000_000
# Distinct words kept by a worker; packing keeps their packed ids only.
CACHED = 600_000


class Pattern(NamedTuple):
    """`count` sequences that hold pieces of these lengths."""

    lengths: tuple[int, ...]
    count: int


class Counts:
    """Pieces left per length, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.left = {s: n for s, n in counts.items() if n > 0}
        self.order = sorted(self.left)

    def take(self, size: int, n: int) -> None:
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]
            self.order.pop(bisect.bisect_left(self.order, size))

    def available(self, size: int, used: tuple[int, ...]) -> int:
        return self.left.get(size, 0) - used.count(size)

    def largest(self, room: int, used: tuple[int, ...]) -> int | None:
        """The largest length that fits, beside the pieces in `used`."""
        at = bisect.bisect_right(self.order, room)
        while at:
            at -= 1
            if self.available(self.order[at], used) > 0:
                return self.order[at]
        return None

    def smallest(self, n: int, used: tuple[int, ...]) -> list[int]:
        found: list[int] = []
        for size in self.order:
            found += [size] * min(n - len(found), max(0, self.available(size, used)))
            if len(found) >= n:
                break
        return found


def dominating_set(counts: Counts, size: int, capacity: int) -> tuple[int, ...] | None:
    """A set holding a piece of `size` that dominates every other such set, if one is found.

    A set dominates another one if the pieces of the other can be grouped so that each
    group fits in the place of a piece of the set. Looked at are sets of up to three pieces:
    alone if nothing fits beside it; with the largest piece that fits if it fills the
    sequence, if no two others fit, or if it is no smaller than any two that fit; with
    two others if at most two fit and no other pair has a larger member in either place.
    """
    room = capacity - size
    used = (size,)
    low = counts.smallest(3, used)
    if not low or low[0] > room:
        return used
    best = counts.largest(room, used)
    assert best is not None
    if best == room or len(low) < 2 or low[0] + low[1] > room:
        return (size, best)
    if len(low) == 3 and sum(low) <= room:
        return None
    most = 0
    for first in counts.order:
        if first > room or counts.available(first, used) <= 0:
            continue
        second = counts.largest(room - first, (size, first))
        if second is not None:
            most = max(most, first + second)
    if best >= most:
        return (size, best)
    second = counts.largest(room - best, (size, best))
    if second is None:
        return None
    # Another pair could only be better in its smaller member: both members above `second`.
    above = counts.order[bisect.bisect_right(counts.order, second) :]
    other = [s for s in above[:2] for _ in range(max(0, min(2, counts.available(s, used))))][:2]
    if len(other) == 2 and sum(other) <= room:
        return None
    return (size, best, second)


def reduce_by_dominance(counts: Counts, capacity: int) -> list[Pattern]:
    """Fix dominating sets for good, from the longest pieces on; `counts` keeps the rest."""
    fixed: list[Pattern] = []
    size = counts.order[-1] if counts.order else None
    while size is not None:
        if size in counts.left:
            found = dominating_set(counts, size, capacity)
            if found is not None:
                times = min(counts.left[s] // found.count(s) for s in set(found))
                # Fewer pieces of these lengths leave fewer other sets, so while the lengths
                # last the same set dominates again.
                for s in found:
                    counts.take(s, times)
                fixed.append(Pattern(found, times))
                continue
        at = bisect.bisect_left(counts.order, size)
        size = counts.order[at - 1] if at else None
    return fixed


def best_fit(counts: Counts, capacity: int) -> list[Pattern]:
    """Best fit of the rest, longest first: each piece goes where it leaves least room."""
    open_: dict[int, list[Pattern]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: Pattern) -> None:
        if not pattern.count:
            return
        if room not in open_:
            bisect.insort(rooms, room)
            open_[room] = []
        open_[room].append(pattern)

    for size in reversed(counts.order):
        left = counts.left[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                # A new sequence takes pieces of this length until it is full.
                each = capacity // size
                put(capacity - each * size, Pattern((size,) * each, left // each))
                if left % each:
                    rest = left % each
                    put(capacity - rest * size, Pattern((size,) * rest, 1))
                left = 0
                continue
            room = rooms[at]
            pattern = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            each = min(room // size, left)
            times = min(left // each, pattern.count)
            put(room - each * size, Pattern(pattern.lengths + (size,) * each, times))
            put(room, Pattern(pattern.lengths, pattern.count - times))
            left -= times * each
    return [p for patterns in open_.values() for p in patterns]


def plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold all pieces of the histogram (length -> pieces)."""
    counts = Counts(histogram)
    if counts.order and not 0 < counts.order[0] <= counts.order[-1] <= capacity:
        raise ValueError(f"lengths must be 1 to {capacity}")
    fixed = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(counts, capacity)


def _cut(path: str, capacity: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    end = END.to_bytes(4, "little")
    width = 4 * capacity

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(path, packed_ids, CACHED)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = b"".join(ids_of.values(text)) + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pieces(
    docs: DataFrame, path: str, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document's ids and an end id, in pieces of at most `capacity`."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return texts(docs, id_col, text_col).mapInPandas(_cut(path, capacity), schema)


def numbered(rows: DataFrame, group: str, order: list[str], key: str) -> DataFrame:
    """Add `rank`: 0, 1, ... within each group, of which one may hold most rows.

    Rows of a group are numbered in parts by the hash of `key`; a part starts after the
    rows of the parts before it.
    """
    n_parts = max(PARTS, -(-rows.count() // ROWS_PER_PART))
    placed = rows.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(n_parts)).cast("int"))
    counts = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part")) - F.col("_n")
    starts = counts.select(group, "_part", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order)) - 1
    return (
        placed.withColumn("_within", within)
        .join(starts, [group, "_part"])
        .withColumn("rank", F.col("_before") + F.col("_within"))
        .drop("_part", "_before", "_within")
    )


def _seats(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: for runs of ranks, where they start, their first sequence, places and offsets."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for lengths, count in patterns:
        offset = 0
        for size in lengths:
            # Each place of a length in a pattern is a run of `count` ranks of its own.
            start = taken.get(size, 0)
            runs.setdefault(size, []).append((start, first, offset, count))
            taken[size] = start + count
            offset += size
        first += count
    return {
        size: tuple(np.array(column, dtype=np.int64) for column in zip(*found, strict=True))
        for size, found in runs.items()
    }


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text by the tokenizer file at `path` and id 0. Only documents longer
    than `capacity` are cut. Null texts are empty (one id). Rows without an id are left
    out, rows that repeat an id count once, an empty table gives no rows.
    """
    cut = stored(pieces(docs, path, capacity, id_col, text_col), "pieces")
    counts = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    seats = _seats(plan({r["length"]: r["n"] for r in counts}, capacity))

    def seat(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence = np.empty(len(frame), dtype=np.int64)
            offset = np.empty(len(frame), dtype=np.int64)
            rank = frame["rank"].to_numpy()
            for size, at in frame.groupby("length").indices.items():
                start, first, place, _ = seats[int(size)]
                run = np.searchsorted(start, rank[at], side="right") - 1
                sequence[at] = first[run] + rank[at] - start[run]
                offset[at] = place[run]
            yield frame.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    schema = (
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint"
    )
    ranked = numbered(cut, "length", ["doc_id", "piece"], "doc_id")
    return ranked.select(*cut.columns, "rank").mapInPandas(seat, schema)
