"""Words and their hashes, vectorised over the byte buffer of an Arrow batch.

A word is a run of bytes other than 0x20 and 0x09-0x0D; these are ASCII, so the
rule is the same on UTF-8 bytes and on characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
U64 = np.uint64

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BYTE = np.random.Generator(np.random.PCG64(0x5EED)).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = U64(base), U64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            factors = np.full(size, self.base)
            factors[0] = 1
            up = np.cumprod(factors)
            factors[1:] = self.inverse
            down = np.cumprod(factors)
            if size > CHUNK_BYTES + 1:  # a giant text must not leave giant tables behind
                return up[:n], down[:n]
            self.up, self.down = up, down
        return self.up[:n], self.down[:n]


BYTES = Powers(0x9E3779B97F4A7C15 | 3)
WORDS = Powers(0xD1342543DE82EF95 | 3)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def range_hash(values: np.ndarray, powers: Powers, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every range ``values[start:end]``: equal ranges have equal hashes wherever they stand."""
    up, down = powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    lengths = (ends - starts).astype(U64)
    return mix((total[ends] - total[starts]) * down[starts] + lengths * U64(0x2545F4914F6CDD1D))


@dataclass
class Words:
    """The words of some rows: where they lie in ``data`` and which row has them."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each row, its first word; one more entry at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=U64)
        i = 0
        while i < len(out):  # by segments, so that a giant text needs no giant tables
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + CHUNK_BYTES, "right")))
            lo = self.starts[i]
            part = self.data[lo : self.ends[j - 1]]
            values = _BYTE[LOWER[part] if lower else part]
            out[i:j] = range_hash(values, BYTES, self.starts[i:j] - lo, self.ends[i:j] - lo)
            i = j
        return out

    def joined(self, row: int, keep: np.ndarray | None = None) -> bytes:
        """The row's (kept) words with one space between them."""
        lo, hi = self.first[row], self.first[row + 1]
        starts, ends = self.starts[lo:hi], self.ends[lo:hi]
        if keep is not None:
            starts, ends = starts[keep], ends[keep]
        return spaced(self.data, starts, ends)


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The given spans of ``data`` with one space between them."""
    if not len(starts):
        return b""
    lengths = ends - starts + 1
    to = np.cumsum(lengths) - lengths
    index = np.arange(int(lengths.sum())) + np.repeat(starts - to, lengths)
    out = data[np.minimum(index, len(data) - 1)]
    out[to + lengths - 1] = 0x20
    return out[:-1].tobytes()


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def find_words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = IS_SPACE) -> Words:
    """Words of the rows ``data[offsets[i]:offsets[i + 1]]``; offsets start at 0, ``gap`` tells which bytes are between words."""
    n = len(data)
    solid = np.zeros(n + 2, dtype=bool)
    solid[1:-1] = ~gap[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    here = solid[1:-1]
    starts = np.flatnonzero(here & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(here & (~solid[2:] | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets, "left"))


def word_chunks(
    column: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES, gap: np.ndarray = IS_SPACE
) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) for slices of about ``size`` bytes; a longer text is a slice of its own."""
    data, off = text_buffers(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1))
        yield i, j, find_words(data[off[i] : off[j]], off[i : j + 1] - off[i], gap)
        i = j


def shingles(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the ``width``-word shingles; a row with fewer words has its whole sequence as one."""
    counts, first = words.counts, words.first[:-1]
    many = np.maximum(counts - width + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), many)
    base = np.cumsum(many) - many
    starts = np.arange(int(many.sum())) - np.repeat(base, many) + np.repeat(first, many)
    ends = starts + np.minimum(counts, width)[row]
    return range_hash(hashes, WORDS, starts, ends), row


def distinct(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs, ordered by row and value."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    return v[new], r[new]
