"""Collocations: phrases of two and three words that occur together more than their parts suggest.

Counting leaves every task as runs sorted in prefix order (first word, second, third; a phrase after the
phrases it begins with), packed with the words they use. Shards merge the runs and keep what is frequent. The
counts of a phrase's parts are then read in lockstep: in prefix order every phrase follows its left part,
in suffix order every phrase follows its right part, so one pass over each sorted stream tells
left, right and extension counts; no table of counts is held in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from openends.llm.common import unique
from openends.llm.jaccard_join import mixed
from openends.llm.word_ids import Vocabulary, cells, chunks
from openends.operators.lookup import attach_lookup
from openends.sources.shared import stored

# Words that a task counts at a time, and different ones among them: three numbers of words fit a long.
FLUSH, DIFFERENT = 1 << 21, 1 << 20
BITS, KEY_BITS = 21, 63
# Bytes of text for one shard of counts.
SHARD_BYTES = 32_000_000

_BREAK = b"\xff"  # no byte of UTF-8; stands for the end of a piece
_CLEAN = bytearray(range(256))
for _byte in b".,;:!?\x0a\x0b\x0c\x0d":
    _CLEAN[_byte] = _BREAK[0]
_CLEAN[0x09] = 0x20
_CLEAN = bytes(_CLEAN)
_STEPS = np.random.default_rng(12).integers(0, 1 << 63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

RUNS = "shard int, lang string, words binary, grams binary, counts binary"


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _loosened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _packed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes; made for sorted ones, whose steps are small."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], n * width, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(kind).ravel()


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their counts (of one each, if none are given)."""
    if counts is None:
        keys, n = np.unique(keys, return_counts=True)
        return keys, n.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts


class Counter:
    """Phrases of up to `longest` words of some texts; words are numbered from 1, 0 ends a piece."""

    def __init__(self, longest: int):
        self.longest = longest
        self.vocabulary = Vocabulary({_BREAK: 0})
        self.parts: dict[str, list[tuple[np.ndarray, int]]] = {}
        self.held = 0

    def add(self, lang: str, ids: np.ndarray, before: int) -> None:
        """Words of one text, the first `before` of which are counted already."""
        self.parts.setdefault(lang, []).append((np.append(ids, np.int32(0)), before))
        self.held += len(ids) + 1

    def runs(self, n_shards: int) -> Iterator[tuple]:
        """Rows of RUNS."""
        words = sorted(self.vocabulary.keys() - {_BREAK})
        rank = np.zeros(len(self.vocabulary), np.int64)
        rank[[self.vocabulary[w] for w in words]] = np.arange(1, len(words) + 1)
        hashes = np.zeros(len(words) + 1, np.uint64)
        hashes[1:] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        for lang, parts in self.parts.items():
            ids = rank[np.concatenate([p for p, _ in parts])]
            fresh = np.concatenate([np.arange(len(p)) >= before for p, before in parts])
            keys = []
            for size in range(1, self.longest + 1):
                m = len(ids) - size + 1
                if m < 1:
                    break
                key, whole = np.zeros(m, np.int64), fresh[size - 1 :].copy()
                for i in range(size):
                    word = ids[i : m + i]
                    whole &= word > 0
                    key |= word << (BITS * (self.longest - 1 - i))
                keys.append(key[whole])
            grams, counts = _summed(np.concatenate(keys))
            columns = _split(grams, BITS, self.longest)
            total = np.full(len(grams), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
            for i, column in enumerate(columns):
                total += hashes[column] * _STEPS[i]
            shard = ((mixed(total) >> np.uint64(20)) % np.uint64(n_shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")  # leaves prefix order within a shard
            ends = np.searchsorted(shard[order], np.arange(n_shards + 1))
            for s in np.flatnonzero(np.diff(ends)):
                part = order[ends[s] : ends[s + 1]]
                used, at = np.unique(np.concatenate([c[part] for c in columns]), return_inverse=True)
                at = at if used[0] == 0 else at + 1  # 0 stays the missing word
                bits = int(at.max()).bit_length()
                grams_ = np.zeros(len(part), np.int64)
                for i, column in enumerate(np.split(at.astype(np.int64), self.longest)):
                    grams_ |= column << (bits * (self.longest - 1 - i))
                names = _squeezed(b" ".join(words[w - 1] for w in used if w))
                steps = np.diff(grams_, prepend=np.int64(0))
                yield int(s), lang, names, bytes([bits]) + _packed(steps), _packed(counts[part])


def _split(keys: np.ndarray, bits: int, size: int) -> list[np.ndarray]:
    """The `size` numbers of `bits` bits each that a key is made of."""
    mask = np.int64((1 << bits) - 1)
    return [(keys >> np.int64(bits * (size - 1 - i))) & mask for i in range(size)]


def count_runs(docs: DataFrame, longest: int, n_shards: int) -> DataFrame:
    """Sorted, packed counts of the phrases of (lang, text), by shard of the phrase."""

    def batch_of(counter: Counter) -> pa.RecordBatch:
        rows = list(counter.runs(n_shards))
        kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["shard", "lang", "words", "grams", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(longest)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), cells(batch.column("text")), strict=True):
                clean = text.lower().translate(_CLEAN).replace(_BREAK, b" \xff ")
                tail: list[bytes] = []
                for chunk in chunks(clean):
                    words = tail + chunk.split()
                    counter.add(lang, counter.vocabulary.ids(words), len(tail))
                    tail = words[-(longest - 1) :] if longest > 1 else []
                    if counter.held >= FLUSH or len(counter.vocabulary) >= DIFFERENT:
                        yield batch_of(counter)
                        counter = Counter(longest)
        yield batch_of(counter)

    return docs.mapInArrow(count, RUNS)


def frequent(runs: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, size, w1, w2, ..., f): phrases that occur `least` times or more.

    Rows of size 0 hold the number of words counted in a shard, rare ones included.
    """
    names = [f"w{i + 1}" for i in range(longest)]

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("lang", "size", *names, "f")}
        for lang, rows in frame.groupby("lang", sort=True):
            number = Vocabulary({b"": 0})
            columns, counts = [[] for _ in names], []
            for own, grams, n in zip(rows["words"], rows["grams"], rows["counts"], strict=True):
                to = np.append(np.int32(0), number.ids(_loosened(own).split(b" ")))
                keys = np.cumsum(_unpacked(grams[1:], np.int64))
                for held, column in zip(columns, _split(keys, grams[0], longest), strict=True):
                    held.append(to[column])
                counts.append(_unpacked(n, np.int64))
            bits = (len(number) - 1).bit_length()
            wide = bits * longest > KEY_BITS
            # Numbers that do not fit one key are replaced by those of the phrases so far.
            key, prefixes = np.concatenate(columns.pop(0)).astype(np.int64), []
            while columns:
                if wide:
                    known, key = np.unique(key, return_inverse=True)
                    prefixes.append(known)
                key <<= np.int64(31 if wide else bits)
                key |= np.concatenate(columns.pop(0))
            key, total = _summed(key, np.concatenate(counts))
            if wide:
                found = []
                for known in reversed(prefixes):
                    found.append(key & np.int64((1 << 31) - 1))
                    key = known[key >> np.int64(31)]
                found = [key, *reversed(found)]
            else:
                found = _split(key, bits, longest)
            single = found[1] == 0 if longest > 1 else np.ones(len(total), bool)
            kept = np.flatnonzero(total >= least)
            words = list(number)
            for name, column in zip(names, found, strict=True):
                out[name] += [words[w].decode() if w else None for w in column[kept]] + [None]
            out["lang"] += [lang] * (len(kept) + 1)
            out["size"] += [*sum((v[kept] > 0).astype(np.int32) for v in found).tolist(), 0]
            out["f"] += [*total[kept].tolist(), int(total[single].sum())]
        return pd.DataFrame(out)

    schema = f"lang string, size int, {', '.join(f'{n} string' for n in names)}, f bigint"
    return runs.groupBy("shard").applyInPandas(merge, schema)


def _with_word(rows: DataFrame, words: DataFrame, word: str, name: str) -> DataFrame:
    """`rows` with the count of one of their words; words of many phrases are spread."""
    sizes = rows.groupBy("lang", word).agg(F.count(F.lit(1)).alias("n_rows"))
    lookup = words.select("lang", F.col("w1").alias(word), F.col("f").alias(name)).join(sizes, ["lang", word])
    return attach_lookup(rows, lookup.hint("merge"), ["lang", word], F.xxhash64("w1", "w2", "w3"), "inner")


def _exact_score(a: str, left: str, right: str) -> F.Column:
    """floor(1000000 a a / (left right)); decimals of 38 digits hold the products of counts below 10^15."""
    return F.expr(
        f"cast((cast({a} as decimal(16,0)) * cast({a} as decimal(16,0)) * cast(1000000 as decimal(7,0)))"
        f" div (cast({left} as decimal(16,0)) * cast({right} as decimal(16,0))) as bigint)"
    )


def collocations(
    docs: DataFrame,
    least: int = 10,
    covered: int = 50,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of two or three words of each language.

    Pieces end at . , ; : ! ? and at line ends, words at blank and tab, A-Z is lower-cased. a is how
    often the phrase occurs in pieces, l and r the counts of its parts at the cut of the lowest score (the
    first of equal ones), n the words of the language, score floor(10^6 a a / (l r)). Phrases occur
    `least` times or more; pairs inside a triple that has `covered` percent of their count or more are dropped.
    Ties go to the larger a, then to the phrase that is first in byte order.

    Null texts are empty, null languages `und`; a language without a phrase has no row. Rows
    that repeat an id count once (the greatest text, then language), rows without one not at all; an
    empty table gives no rows; further columns are not read. Texts of any length are counted whole.
    """
    rows = unique(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
            F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
        )
    ).select("lang", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counted = frequent(count_runs(rows, 3, max(12, size // SHARD_BYTES + 1)), 3, least)
    counted = stored(counted, "counts")
    n = counted.filter("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    words = counted.filter("size = 1").select("lang", "w1", "f")
    phrases = counted.filter("size > 1")

    # Prefix order: a pair is followed by the triples that begin with it.
    prefix = Window.partitionBy("lang", "w1", "w2")
    in_order = prefix.orderBy(F.col("w3").asc_nulls_first())
    phrases = phrases.withColumns(
        {
            "left_part": F.first("f").over(in_order),
            "longer_right": F.max(F.when(F.col("size") == 3, F.col("f"))).over(prefix),
        }
    )
    # Suffix order: a pair is followed by the triples that end with it.
    last = F.when(F.col("size") == 3, F.col("w3")).otherwise(F.col("w2"))
    before = F.when(F.col("size") == 3, F.col("w2")).otherwise(F.col("w1"))
    front = F.when(F.col("size") == 3, F.col("w1"))
    phrases = phrases.withColumns({"last": last, "before": before, "front": front})
    suffix = Window.partitionBy("lang", "last", "before")
    in_order = suffix.orderBy(F.col("front").asc_nulls_first())
    phrases = phrases.withColumns(
        {
            "right_part": F.first("f").over(in_order),
            "longer_left": F.max(F.when(F.col("size") == 3, F.col("f"))).over(suffix),
        }
    )
    longer = F.greatest("longer_left", "longer_right")
    phrases = phrases.filter((F.col("size") == 3) | longer.isNull() | (100 * longer < covered * F.col("f")))
    # Written, so that the look-ups of first and last words read it twice at no cost.
    phrases = stored(phrases.drop("before", "front", "longer_left", "longer_right"), "phrases")
    phrases = _with_word(phrases, words, "w1", "first_word")
    phrases = _with_word(phrases, words, "last", "last_word")

    scored = phrases.withColumns(
        {
            "one": _exact_score("f", "first_word", "case when size = 3 then right_part else last_word end"),
            "two": F.when(F.col("size") == 3, _exact_score("f", "left_part", "last_word")),
        }
    )
    second = F.col("two").isNotNull() & (F.col("two") < F.col("one"))
    whole = F.when(F.col("size") == 3, F.concat_ws(" ", "w1", "w2", "w3")).otherwise(F.concat_ws(" ", "w1", "w2"))
    scored = scored.select(
        "lang",
        whole.alias("phrase"),
        F.col("f").alias("a"),
        F.when(second, F.col("left_part")).otherwise(F.col("first_word")).alias("l"),
        F.when(second | (F.col("size") == 2), F.col("last_word")).otherwise(F.col("right_part")).alias("r"),
        F.when(second, F.col("two")).otherwise(F.col("one")).alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(n, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
