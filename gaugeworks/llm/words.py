"""Words of Arrow text columns as flat numpy arrays: positions, hashes, and hashes of runs of words.

A word is a run of bytes other than space and 0x09 to 0x0D, which is the same
on UTF-8 bytes as on code points.  Hashes are polynomials modulo 2**64 taken
from prefix sums, so a run of k words costs two look-ups whatever k is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ONE = np.uint64(1)
SEGMENT = 1 << 18  # bytes hashed at a time: the tables of powers stay in cache


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def powers(base: int, n: int, held: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n; base is odd."""
    held = _POWERS if held is None else held
    got = held.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, SEGMENT + 1)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        got = held[base] = tuple(pair)
    return got[0][:n], got[1][:n]


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
BYTE_BASE = 0x2545F4914F6CDD1D
RUN_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


@dataclass
class Words:
    """Words of a column: byte range of each in ``data``, and the first word of each row (one more at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False, seed: int = 7) -> np.ndarray:
        """A 64-bit hash of every word; ``lower`` reads A-Z as a-z."""
        out = np.empty(len(self.starts), np.uint64)
        values = byte_values(seed)[LOWER] if lower else byte_values(seed)
        a = 0
        while a < len(self.starts):
            base = int(self.starts[a])
            b = max(a + 1, int(np.searchsorted(self.ends, base + SEGMENT, side="right")))
            piece = self.data[base : int(self.ends[b - 1])]
            up, down = powers(BYTE_BASE, len(piece) + 1)
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(values[piece] * up[:-1], out=sums[1:])
            s, e = self.starts[a:b] - base, self.ends[a:b] - base
            out[a:b] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
            a = b
        return mix(out)


def words_of(column: pa.Array) -> Words:
    """Words of a string column; null has none."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    solid = ~SPACE[data]
    before = np.empty(len(data) + 1, bool)  # whether a word may not run on from the byte before
    before[0] = before[-1] = True
    before[1:-1] = ~solid[:-1]
    after = np.ones(len(data) + 1, bool)
    after[:-1] = ~solid
    before[offsets] = True
    after[offsets] = True
    starts = np.flatnonzero(solid & before[:-1])
    ends = np.flatnonzero(solid & after[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def runs(hashes: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every k consecutive values; ``which`` picks one of two independent ones."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(RUN_BASES[which], len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes + np.uint64(which)) * up[:-1], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[:n])


def starts_of_runs(first: np.ndarray, k: int) -> np.ndarray:
    """Whether k values from each position stay within its row; one flag for every value."""
    ok = np.ones(int(first[-1]), bool)
    last = np.zeros(len(ok) + 1, np.int32)
    ends = first[1:]
    np.add.at(last, np.maximum(first[:-1], ends - k + 1), 1)
    np.add.at(last, ends, -1)
    return ok & (np.cumsum(last[:-1]) == 0)


def by_size(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(sizes):
            done = int(sizes[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(sizes, done + limit, side="right")))
            yield batch.slice(a, b - a)
            a = b
