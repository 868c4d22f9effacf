"""Words and rolling hashes of whole Arrow batches, computed with numpy inside Spark tasks.

A word is a run of bytes outside space and ``\\x09``-``\\x0D``; in UTF-8 these never occur inside a character, so
splitting bytes equals splitting characters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C55)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SAME = np.arange(256, dtype=np.uint64)
_LOWER = _SAME.copy()
_LOWER[ord("A"):ord("Z") + 1] += np.uint64(32)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@dataclass
class Words:
    """All words of some texts: byte bounds within the joined bytes, hashes, and where the words of each text begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo 2**64."""
    size = 1 << max(12, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, BASE, np.uint64), np.full(size, BASE_INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Joined bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = _texts(column)
    inside = ~_SPACE[data]
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | fresh[:-1]))
    ends = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(((_LOWER if lower else _SAME)[data] + np.uint64(1)) * up[:len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` consecutive word hashes."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    return mix((sums[width:] - sums[:count]) * down[:count] + np.uint64(width))


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words; a shorter text is one run; no words, none."""
    runs = windows(words.hashes, width)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= width:
            yield np.unique(runs[a:b - width + 1])
        else:
            yield windows(words.hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.int64).view(np.uint64)


def pieces(batches: Iterable[pa.RecordBatch], texts: tuple[str, ...] = ("text",), limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the named text columns hold about ``limit`` bytes at most, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = sum(pc.fill_null(pc.binary_length(batch.column(t)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
        total, at = np.concatenate(([0], np.cumsum(lengths))), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
