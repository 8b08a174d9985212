"""Whole Arrow string columns as numpy arrays: word spans, span hashes, shingles.

Everything works on the UTF-8 bytes of many texts at once (one buffer plus
offsets), so a batch costs a fixed number of numpy passes and no Python loop
over words. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Odd multiplier of the span hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SHINGLE_WORDS = 5
SLICE_BYTES = 1 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i in 0..n (kept per worker, grown by doubling)."""
    have = _powers.get(0)
    if have is None or len(have[0]) <= n:
        size = 1 << max(16, int(n).bit_length())
        tables = []
        for factor in (BASE, INVERSE):
            t = np.full(size, factor, dtype=U64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        have = _powers[0] = (tables[0], tables[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (starting at 0) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``limit`` text bytes (one row at least)."""
    _, offsets = buffers(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def row_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row that each byte position belongs to."""
    return np.searchsorted(offsets, positions, "right") - 1


def runs_within(counts: np.ndarray) -> np.ndarray:
    """0,1,..,c0-1, 0,1,..,c1-1, ... for the given counts."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(first, counts)


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes not ``between`` (by default white space); runs end at row ends."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    word = ~between[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1]))
    after = np.concatenate((word[1:], [False]))
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, row_of(starts, offsets)


class SpanHasher:
    """64-bit hashes of spans of one array, by prefix sums modulo 2**64 taken once."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.total = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum((values.astype(U64) + U64(1)) * up[: len(values)], out=self.total[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spans = (self.total[ends] - self.total[starts]) * self.down[starts]
        return mix(spans + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for each span."""
    return SpanHasher(values).hash(starts, ends)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle of ``width`` words, row by row in text order.

    A text of 1 to width-1 words has one shingle (all its words); one without
    words has none.
    """
    starts, ends, rows = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    per_row = np.bincount(rows, minlength=len(offsets) - 1).astype(np.int64)
    counts = np.where(per_row >= width, per_row - width + 1, np.minimum(per_row, 1))
    first = np.cumsum(per_row) - per_row
    begin = np.repeat(first, counts) + runs_within(counts)
    length = np.repeat(np.minimum(per_row, width), counts)
    return span_hashes(words, begin, begin + length), np.repeat(np.arange(len(counts)), counts)
