"""Words of many texts as small numbers, for counting with arrays inside a task."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# White space between words: blank and the controls tab to carriage return.
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
# Bytes of a text that are split at a time.
CHUNK = 1 << 20


def chunks(data: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """A text in pieces of about `size` bytes, cut at white space only."""
    start = 0
    while len(data) - start > size:
        found = _SPACE.search(data, start + size)
        if found is None:
            break
        yield data[start : found.start()]
        start = found.end()
    yield data[start:] if start else data


class Vocabulary(dict):
    """Words in the order they are first seen; asking for a new word numbers it."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def cells(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """The values of a string or binary column as bytes, one at a time; null is empty."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    for part in parts:
        for value in part.cast(pa.large_binary()):
            yield value.as_py() or b""
