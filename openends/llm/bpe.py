"""BPE encoding and decoding of whole texts with public tokenizer files.

A text is cut where no token can cross: at white space. The ids of the parts are kept in a
bounded cache, since words repeat. A part longer than LONG characters, such as a run of
letters without a break, is encoded by tree concatenation.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from openends.llm.common import texts

# Parts beyond this many characters are encoded by tree concatenation, in leaves of LEAF.
LONG = 128
LEAF = 64
# Words that are new to the cache and encoded in one call of the library.
TOGETHER = 100
# Parts in one generation of the cache; there are two.
CACHED = 300_000

# The separators U+001C to U+001F are white space to str.split but not to the tokenizers.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[^\\S\x1c-\x1f]+")
# Where a space has white space on both sides or a space beside it, runs of white space
# are tokens of their own and the text is not cut at spaces.
_RUN = re.compile(r"  |\s \s")
# The same for Arrow's regular expressions, whose \s is ASCII only.
_RUN_ARROW = r"  |[\t-\r\x1c-\x1f\x{85}\p{Z}] [\t-\r\x1c-\x1f\x{85}\p{Z}]"
# Latin letters without "İ", whose lower case is two characters.
_SIMPLE = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u024f]+)([.,]?)")


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def join_tree(parts: list[list[int]], again: Callable[[list[int], bool], list[int]]) -> list[int]:
    """The ids of a run of characters from those of its consecutive parts.

    Neighbours are joined pairwise, level by level. At a join the last ids of the left
    and the first of the right side are turned back into characters and encoded together,
    in windows that double until the outermost new ids on both sides are the old
    ones. Every pair of neighbouring ids then stands as it does in one encoding of their
    characters, which makes the whole sequence the encoding of the whole run.

    `again(ids, at_end)` encodes the characters of `ids` anew; `at_end` tells that they end the run.
    """
    while len(parts) > 1:
        joined = []
        for i in range(0, len(parts), 2):
            if i + 1 == len(parts):
                joined.append(parts[i])
                continue
            left, right = parts[i], parts[i + 1]
            last = i + 2 >= len(parts)
            size = 2
            while True:
                a, b = min(size, len(left)), min(size, len(right))
                new = again(left[len(left) - a :] + right[:b], last and b == len(right))
                left_agrees = a == len(left) or new[:1] == left[len(left) - a :][:1]
                right_agrees = b == len(right) or new[-1:] == right[:b][-1:]
                if left_agrees and right_agrees and (len(new) > 1 or (a == len(left) and b == len(right))):
                    break
                size *= 2
            joined.append(left[: len(left) - a] + new + right[b:])
        parts = joined
    return parts[0]


class Encoder(dict):
    """Values of text parts by part, made from their ids with `make`; `values(text)` gives a text's.

    As a dict it is the younger half of the cache: a part that is missing is looked up in
    the older half, else encoded.
    """

    def __init__(self, path: str, make: Callable[["Encoder", list[int]], Any], cached: int = CACHED):
        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path) as file:
            spec = json.load(file)
        self.by_word = (spec["pre_tokenizer"] or {}).get("type") == "Sequence" and any(
            p.get("behavior") == "Removed" and p.get("invert") and "\\s" in p["pattern"]["Regex"]
            for p in spec["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"
        )
        self.lower = "Lowercase" in json.dumps(spec["normalizer"])
        self.decoder = spec["decoder"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        bare = spec | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
        self.run_end = Tokenizer.from_str(json.dumps(bare))
        middle = bare | {"model": spec["model"] | {"end_of_word_suffix": None}}
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.run_middle = Tokenizer.from_str(json.dumps(middle)) if self.suffix else self.run_end
        self.alphabet = _byte_alphabet()
        self.marks = {m: self.run_end.encode(m, add_special_tokens=False).ids for m in ".,"}
        self.make = make
        self.cached = cached
        self.older: dict = {}
        space = self.alphabet[32]
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.spaced = np.zeros(max(self.library.get_vocab().values()) + 1, dtype=bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(space)]] = True

    def __missing__(self, part: str) -> Any:
        value = self.older.get(part)
        if value is None:
            value = self.make(self, self.part_ids(part))
        self.keep(part, value)
        return value

    def keep(self, part: str, value: Any) -> None:
        if len(self) >= self.cached:
            self.older = dict(self)
            self.clear()
        self[part] = value

    def follow(self, words: list[str]) -> list[bytes]:
        """Packed ids of words as they follow a space; new ones are encoded many in one call of the library.

        Such words are encoded side by side, each with its space. No token crosses the space before a word
        that begins with no white space, and the first ids of words, and only these, are of tokens with
        a space in front. Other words, long ones and special tokens are encoded one by one.
        """
        parts = [" " + w for w in words]
        values = list(map(self.get, parts))
        new = []
        for i in [i for i, v in enumerate(values) if v is None]:
            part = parts[i]
            if part in self.older or not 1 < len(part) <= LONG or part[1].isspace():
                values[i] = self[part]
            else:
                new.append(i)
        for k in range(0, len(new), TOGETHER):
            places = new[k : k + TOGETHER]
            some = [parts[i] for i in places]
            text = "".join(some)
            if self.special and self.specials.search(text):
                for i in places:
                    values[i] = self[parts[i]]
                continue
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) != len(some):
                raise ValueError("the tokenizer does not cut words at the space before them")
            packed, at = ids.tobytes(), (4 * starts).tolist()
            for i, part, a, b in zip(places, some, at, [*at[1:], len(packed)], strict=True):
                values[i] = packed[a:b]
                self.keep(part, values[i])
        return values

    def parts(self, text: str) -> list[str]:
        """The text cut where no token can cross."""
        if self.by_word:
            if _SEPARATORS.search(text):
                return [p for p in _SPACE.split(text) if p]
            return text.split()
        if not text:
            return []
        if _RUN.search(text):
            return [text]
        first, *others = text.split(" ")
        return ([first] if first else []) + [" " + p for p in others]

    def values(self, text: str) -> list[Any]:
        return list(map(self.__getitem__, self.parts(text)))

    def ids(self, text: str) -> list[int]:
        return [i for part in self.parts(text) for i in self.part_ids(part)]

    def part_ids(self, part: str) -> list[int]:
        if len(part) > LONG:
            return self.long_ids(part)
        simple = _SIMPLE.fullmatch(part)
        if simple and not (simple[1] and self.by_word):
            # One run of letters that normalising leaves as they are, and perhaps a mark.
            run = simple[2].lower() if self.lower else simple[2]
            if not run.isascii():
                run = "".join(map(self.alphabet.__getitem__, run.encode()))
            run = self.alphabet[32] + run if simple[1] else run
            found = self.run_end.encode(run, add_special_tokens=False).ids
            if simple[3]:
                found = found + self.marks[simple[3]]
            return found
        return self.library.encode(part, add_special_tokens=False).ids

    def long_ids(self, part: str) -> list[int]:
        """Ids of a part by its runs, as the library cuts them, the long ones as a tree."""
        found: list[int] = []
        for piece in self.specials.split(part) if self.special else [part]:
            if piece in self.special:
                found.append(self.special[piece])
                continue
            normal = self.library.normalizer
            plain = normal.normalize_str(piece) if normal else piece
            for run, _ in self.library.pre_tokenizer.pre_tokenize_str(plain):
                found += self.run_ids(run)
        return found

    def run_ids(self, run: str) -> list[int]:
        """Ids of one run; leaves are encoded together, which the library does in parallel."""
        if len(run) <= 2 * LEAF:
            return self.run_end.encode(run, add_special_tokens=False).ids
        leaves = [run[i : i + LEAF] for i in range(0, len(run), LEAF)]
        encoded = self.run_middle.encode_batch(leaves[:-1], add_special_tokens=False)
        parts = [e.ids for e in encoded]
        parts.append(self.run_end.encode(leaves[-1], add_special_tokens=False).ids)
        return join_tree(parts, self.encode_again)

    def encode_again(self, ids: list[int], at_end: bool) -> list[int]:
        run = "".join(map(self.run_end.id_to_token, ids))
        if not at_end:
            return self.run_middle.encode(run, add_special_tokens=False).ids
        return self.run_end.encode(run.removesuffix(self.suffix), add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids, skip_special_tokens=False)


def packed_ids(encoder: Encoder, ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def column_ids(encoder: Encoder, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each followed by `end`; how many ids each text has with it).

    `encoder` makes packed ids. A word is looked up once however often the column has it, and
    the ids are gathered by its number. Its words are those of `Encoder.parts`.
    """
    texts = texts.cast(pa.large_string())
    if encoder.by_word:
        runs = np.ones(len(texts), dtype=bool)
    else:
        runs = pc.match_substring_regex(texts, _RUN_ARROW).to_numpy(zero_copy_only=False)
    split = pc.split_pattern(pc.if_else(pa.array(runs), "", texts), " ")
    words = split.flatten()
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    # A text begins with a word without a space, or is one part as a whole, and ends with the end id.
    first = words.take(pa.array(offsets[:-1])).to_pylist()
    for i in np.flatnonzero(runs).tolist():
        first[i] = texts[i].as_py()
    spaced = np.ones(len(words), dtype=bool)
    spaced[offsets[:-1]] = False
    coded = words.filter(pa.array(spaced)).dictionary_encode()
    values = encoder.follow(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    codes = np.zeros(len(words), dtype=np.int64)
    codes[spaced] = coded.indices.to_numpy()
    codes[~spaced] = len(values) + np.arange(len(first))
    for text, run in zip(first, runs.tolist(), strict=True):
        values.append(b"".join(encoder.values(text)) if run else encoder[text] if text else b"")
    codes = np.insert(codes, offsets[1:], len(values))
    values.append(end.to_bytes(4, "little"))
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // 4
    flat = np.frombuffer(b"".join(values), dtype="<u4")
    lengths = sizes[codes]
    ends = np.cumsum(lengths)
    shift = (np.cumsum(sizes) - sizes)[codes] - (ends - lengths)
    places = np.repeat(shift, lengths)
    places += np.arange(len(places))
    ids = flat.take(places)
    last = ends[offsets[1:] + np.arange(len(first))]
    return ids, np.diff(last, prepend=0)


def _written(encoder: Encoder, ids: list[int]) -> tuple[int, str, str]:
    tokens = " ".join(map(encoder.library.id_to_token, ids)) if encoder.decoder is None else ""
    return len(ids), " ".join(map(str, ids)), tokens


@lru_cache(maxsize=2)
def encoder(path: str, make: Callable, cached: int = CACHED) -> Encoder:
    """One encoder per worker process and file, with its cache."""
    return Encoder(path, make, cached)


def _digest(path: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from openends.llm.bpe import _written as made

        encode = encoder(path, made, CACHED // 2)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                values = encode.values(text)
                ids = " ".join([v[1] for v in values])
                if encode.decoder is None:
                    decoded = " ".join([v[2] for v in values])
                else:
                    decoded = encode.decode([int(i) for i in ids.split()])
                rows.append(
                    (
                        doc_id,
                        sum([v[0] for v in values]),
                        hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest(),
                    )
                )
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def encode_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, without a shuffle.

    The ids are those of the tokenizers library for the file at `path`, without added special tokens;
    special tokens written in a text are found as the library does. Decoding keeps them.
    Null texts are empty and have no ids. Rows without an id are left out, rows that repeat an id count once.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return texts(docs, id_col, text_col).mapInPandas(_digest(path), schema)


def _encoded(path: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(path, packed_ids)
        for frame in frames:
            packed = [b"".join(ids_of.values(t)) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": packed})

    return encode


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids): every document's ids as packed little-endian unsigned 32-bit numbers."""
    return texts(docs, id_col, text_col).mapInPandas(_encoded(path), "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids), special tokens kept."""

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = encoder(path, packed_ids)
        for frame in frames:
            text = [decoder.decode(memoryview(p).cast("I").tolist()) for p in frame["ids"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "text": text})

    return encoded.mapInPandas(decode, "doc_id bigint, text string")
