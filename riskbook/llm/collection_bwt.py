"""Burrows-Wheeler transform and common prefixes of a collection, built column by column.

Each round inserts one symbol per string, from the right end: the suffixes of
length t come to their places among all shorter ones by the last-to-first mapping of the transform
so far, and the lengths of common prefixes beside them follow from range minima
between equal symbols. The transform, the prefix lengths and the suffixes'
owners are sequential arrays, read and rewritten once in each round, so the
work is (symbols) x (longest string) / 2. Strings here are short and blocks bounded, which is why the arrays
stay in memory instead of files.
"""

from __future__ import annotations

import numpy as np

NO_SYMBOL = 0  # before the first symbol of a string


def suffix_order(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String and length of every suffix of the strings data[offsets[i]:offsets[i+1]] in
    ascending order (empty ones first, equal ones by string), and the length of
    the common prefix of each with the one before it. Strings hold at most 254 bytes."""
    lengths = np.diff(offsets)
    n = len(lengths)
    if n and lengths.max() > 254:
        raise ValueError("strings of more than 254 bytes")
    # Symbols are the bytes that occur, in order, from 1; one byte each unless all 256 occur.
    code = np.cumsum(np.bincount(data, minlength=256) > 0)
    symbol = code.astype(np.uint8 if code[-1] < 256 else np.uint16)[data]
    # Round 0: the empty suffixes, each with the last symbol of its string before it.
    bwt = np.full(n, NO_SYMBOL, dtype=symbol.dtype)
    string = np.flatnonzero(lengths > 0)
    bwt[string] = symbol[offsets[1:][string] - 1]
    lcp = np.zeros(n, dtype=np.uint8)
    place = string.astype(np.int64)  # where the latest suffix of each unfinished string stands
    t = 0
    while len(string):
        t += 1
        size = len(bwt)
        order, rank, ended = _mapping(bwt)
        by_rank = np.argsort(rank[place], kind="stable")
        k, string = rank[place][by_rank], string[by_rank]
        # The k-th symbol in sorted order starts the suffix at n + k - ended of the new list.
        at = n + k - ended
        beside = np.zeros(size + 1, dtype=bool)
        beside[k - 1] = beside[k] = True
        beside[: max(ended, 0)] = False
        pairs = np.flatnonzero(beside[: size - 1])
        pairs = pairs[bwt[order[pairs]] == bwt[order[pairs + 1]]]
        # Common prefixes beside the new suffixes: one more than the least between two equal symbols.
        pairs = pairs[np.argsort(order[pairs], kind="stable")]
        if len(pairs):
            bounds = np.stack((order[pairs] + 1, order[pairs + 1] + 1), axis=1).ravel()
            shared = np.minimum.reduceat(np.append(lcp, np.uint8(0)), bounds)[::2] + np.uint8(1)
        # Rewrite both sequences with the new suffixes in place.
        grown = size + len(string)
        old = np.ones(grown, dtype=bool)
        old[at] = False
        bwt, lcp = _spread(bwt, old, grown), _spread(lcp, old, grown)
        more = lengths[string] > t
        bwt[at[more]] = symbol[offsets[string[more] + 1] - 1 - t]
        if len(pairs):
            lcp[n + pairs + 1 - ended] = shared
        place, string = at[more], string[more]
    return *_owners(bwt, lengths), lcp


def _mapping(bwt: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Places in order of their symbols, the rank of each place in it, and the number of places without a symbol."""
    order = np.argsort(bwt, kind="stable")
    rank = np.empty(len(bwt), dtype=np.int32)
    rank[order] = np.arange(len(bwt), dtype=np.int32)
    return order, rank, int(np.count_nonzero(bwt == NO_SYMBOL))


def _owners(bwt: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """String and length of every suffix, by following the mapping from the empty suffixes."""
    n = len(lengths)
    owner, length = np.empty(len(bwt), dtype=np.int32), np.empty(len(bwt), dtype=np.uint8)
    string = place = np.arange(n)
    owner[:n], length[:n] = string, 0
    _, rank, ended = _mapping(bwt)
    t = 0
    while len(string):
        t += 1
        go = lengths[string] >= t
        string, place = string[go], n + rank[place[go]] - ended
        owner[place], length[place] = string, t
    return owner, length


def _spread(x: np.ndarray, old: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, dtype=x.dtype)
    out[old] = x
    return out
