"""Words of whole Arrow batches of text as NumPy arrays.

A word is a run of bytes outside 0x20 and 0x09-0x0D, which in UTF-8 is the same as a run of characters
outside those. Words are found and hashed for many texts at once; nothing loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_WORD_BASE = 0xD6E8FEB86659FD93
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    known = _tables.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            both.append(np.multiply.accumulate(table))
        known = _tables[base] = (both[0], both[1])
    return known[0][:n], known[1][:n]


def polynomial(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of each slice values[start:end], equal for equal slices wherever they stand."""
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of the texts `first` to `last` of a batch. Places count bytes of `data`."""

    first: int
    last: int
    data: np.ndarray  # bytes of the texts, one after the other
    texts: np.ndarray  # place where each text starts, and the end
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # index of each text's first word, and the number of words
    is_word: np.ndarray

    def hashes(self) -> np.ndarray:
        return polynomial(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends)

    def text(self, i: int) -> bytes:
        return self.data[self.texts[i] : self.texts[i + 1]].tobytes()


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each place on, over text borders too; empty if there are fewer words."""
    at = np.arange(max(0, len(hashes) - size + 1))
    return polynomial(hashes, at, at + size, _WORD_BASE)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")


def split_words(column: pa.Array, lower: bool = False, chunk_bytes: int = CHUNK_BYTES, space: np.ndarray = _SPACE) -> Iterator[Words]:
    """Words of all texts of a column without nulls, in chunks of whole texts. `lower` maps A-Z to a-z; `space` marks the
    bytes between words."""
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + chunk_bytes, "right")) - 1)
        part = whole[at[first] : at[last]]
        if lower:
            part = _LOWER[part]
        texts = at[first : last + 1] - at[first]
        is_word = ~space[part]
        filled = texts[:-1][texts[1:] > texts[:-1]]
        before = np.zeros(len(part), bool)
        before[1:] = is_word[:-1]
        before[filled] = False
        starts = np.flatnonzero(is_word & ~before)
        after = np.zeros(len(part), bool)
        after[:-1] = is_word[1:]
        after[filled[filled > 0] - 1] = False
        ends = np.flatnonzero(is_word & ~after) + 1
        yield Words(first, last, part, texts, starts, ends, np.searchsorted(starts, texts), is_word)
        first = last
