"""Removal of long repeated strings: every byte covered by a string of ``length``
bytes that also starts earlier, in a smaller document or earlier in the same one.

Suffix sorting brings equal strings together. Here the suffixes are first dealt to
groups that equal strings cannot leave, so that every task sorts a bounded
collection, and only suffixes that can have an equal partner are sorted at all:

1. Anchors. Of the GRAM-byte grams in each string of ``length`` bytes the one
   with the smallest hash (leftmost of equals) is its anchor. Equal strings have equal
   anchors at equal distance. Strings in a row that share an anchor form a
   fragment; a document of n bytes has about n / 40 of them. One shuffle
   brings equal anchors together as (anchor hash, fragment hash, position).
2. Within an anchor's group, fragments equal to an earlier one are repeated as a
   whole, and need no sorting. Equal fragments within a task's batch are found before
   the shuffle, which takes the copies out of hot groups. A fragment whose anchor occurs
   nowhere else is done, too.
3. What remains are first occurrences of fragments that share an anchor but
   differ. Their bytes are fetched, and blocks of whole groups are taken: what shares no
   window beside the anchor with another fragment can share no string either, and is left out
   (:func:`comparable`); the rest is sorted by column-wise construction of the Burrows-Wheeler transform and common prefixes of the
   collection (:mod:`collection_bwt`). Neighbouring suffixes with a common
   prefix of ``length`` are equal strings: all but the earliest are repeated.
   An anchor group above ``largest_group`` fragments is not sorted in one task: its
   strings go by their own 128-bit hash to a partially aggregated minimum, which
   finds the same repeats.
4. Repeated starts are collected per document, and the covered bytes removed.

The document texts are shuffled once, for 3 and 4 together (the two joins share
the exchange).

Defined results: null text is empty; texts shorter than ``length`` keep all
bytes; rows with equal doc_id and text are one document, each row with the same result; rows with equal doc_id and different texts
are compared by start alone (at equal starts neither is earlier); null doc_ids
come after all others; removal may leave bytes that are not valid UTF-8, hence the digest of bytes;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.collection_bwt import suffix_order
from riskbook.llm.common import stored
from riskbook.llm.text_arrays import U64, SpanHasher, buffers, mix, runs_within, slices

LENGTH = 100
GRAM = 24
BLOCK = 2048
LARGEST_GROUP = 32768
LAST_ID = (1 << 63) - 1
#: Low bits of a gram's rank that hold its position, so the leftmost of equal grams is smallest.
PLACE_BITS = 22
#: Windows beside the anchor that a fragment needs in common with another one.
WINDOWS = 4
SEGMENT = 1 << 21
SLICE = 1 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, fragment hash, row, first start (in data) and number of starts
    of the fragments of all rows."""
    parts = []
    window = length - gram + 1
    # Rows longer than a segment are taken in segments that overlap by one string.
    row_ends = offsets[1:]
    for begin in range(0, max(len(data) - length + 1, 0), SEGMENT):
        end = min(len(data), begin + SEGMENT + length - 1)
        piece = data[begin:end]
        if len(piece) < length:
            break
        hasher = SpanHasher(piece)
        n = len(piece) - gram + 1
        grams = mix((hasher.total[gram:] - hasher.total[:-gram]) * hasher.down[:n])
        least = (grams & ~U64((1 << PLACE_BITS) - 1)) | np.arange(n, dtype=U64)
        step = 1
        while 2 * step <= window:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < window:
            least = np.minimum(least[: step - window], least[window - step :])
        anchor = (least & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
        start = np.arange(len(anchor))
        row = np.searchsorted(offsets, start + begin, "right") - 1
        inside = start + begin + length <= row_ends[row]
        start, anchor, row = start[inside], anchor[inside], row[inside]
        if not len(start):
            continue
        new = np.ones(len(start), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(start)))
        at, anchor = start[first], anchor[first]
        content = hasher.hash(at, at + count - 1 + length) ^ mix((anchor - at).astype(U64))
        parts.append((mix(grams[anchor] + U64(1)), content, row[first], at + begin, count))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(U64), none.astype(U64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


MARKS = "h long, f long, node long, variant long, start int, n int, known boolean"
NAMES = [c.split()[0] for c in MARKS.split(", ")]


def _batch(h, f, node, variant, start, n, known) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(f.view(np.int64)), pa.array(node), pa.array(variant), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(known)], names=NAMES
    )


def _marks(length: int, gram: int):
    """Fragments of a batch; those equal to an earlier one of the batch are known repeats, joined to runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                data, offsets = buffers(part.column(2))
                h, f, row, at, n = anchors(data, offsets, length, gram)
                if not len(h):
                    continue
                node = part.column(0).to_numpy()[row]
                variant = part.column(1).to_numpy()[row]
                start = at - offsets[row]
                order = np.lexsort((start, variant, node, f, h))
                h, f, node, variant, start, n = (x[order] for x in (h, f, node, variant, start, n))
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (f[1:] != f[:-1])
                first = np.flatnonzero(new)[np.cumsum(new) - 1]
                same = (node == node[first]) & (variant == variant[first]) & (start == start[first])
                again = ~new & ~same  # later than the first; equal rows of one document are not
                yield _batch(h[new], f[new], node[new], variant[new], start[new], n[new], np.zeros(int(new.sum()), dtype=bool))
                if again.any():
                    node, variant, start, n = joined_runs(node[again], variant[again], start[again], n[again])
                    spread = mix(node.astype(U64) + start.astype(U64))
                    yield _batch(spread, spread, node, variant, start, n, np.ones(len(node), dtype=bool))

    return run


def joined_runs(node: np.ndarray, variant: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of starts, with those that touch or overlap in one document joined."""
    order = np.lexsort((start, variant, node))
    node, variant, start, stop = node[order], variant[order], start[order].astype(np.int64), (start + n)[order].astype(np.int64)
    other = np.ones(len(node), dtype=bool)
    other[1:] = (node[1:] != node[:-1]) | (variant[1:] != variant[:-1])
    # Furthest stop so far within the document, by a running maximum over documents set far apart.
    apart = (np.cumsum(other) - 1) * (int(stop.max(initial=0)) + 1)
    reach = np.maximum.accumulate(stop + apart) - apart
    new = other.copy()
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return node[first], variant[first], start[first], reach[np.append(first[1:], len(node)) - 1] - start[first]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From marks sorted by (h, f, node, variant, start): known repeats (known), and
    first occurrences of fragments that share their anchor with different ones (not known).

    Only one row waits between batches: the first row of the latest fragment,
    with whether its group has shown another fragment before it."""
    held: tuple | None = None
    several = False
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        known = cols[6]
        if known.any():
            yield batch.filter(pa.array(known))
        h, f, node, variant, start, n = (c[~known] for c in cols[:6])
        if not len(h):
            continue
        waits = held is not None
        if waits:
            h, f, node, variant, start, n = (np.concatenate((np.array([x], dtype=c.dtype), c)) for x, c in zip(held, (h, f, node, variant, start, n), strict=True))
        new_group = np.ones(len(h), dtype=bool)
        new_group[1:] = h[1:] != h[:-1]
        new = new_group.copy()
        new[1:] |= f[1:] != f[:-1]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = ~new & ~((node == node[first]) & (variant == variant[first]) & (start == start[first]))
        group = np.cumsum(new_group) - 1
        fragments = np.bincount(group, weights=new)
        shared = fragments > 1
        shared[0] |= waits and several
        out = new & shared[group]
        if waits and several:
            out[0] = False  # given out before
        for take, flag in ((again, True), (out, False)):
            if take.any():
                yield _batch(h[take], f[take], node[take], variant[take], start[take], n[take], np.full(int(take.sum()), flag))
        last = int(first[-1])
        held = (h[last], f[last], node[last], variant[last], start[last], n[last])
        several = bool(shared[-1])


FRAGMENT = "h long, node long, variant long, start int, bytes binary"


def _fetch(length: int):
    """The bytes of the marked fragments of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                data, offsets = buffers(part.column(3))
                marks = part.column(4)
                at = marks.offsets.to_numpy()
                flat = marks.values.slice(at[0], at[-1] - at[0])
                h, start, n = (flat.field(k).to_numpy() for k in range(3))
                row = np.repeat(np.arange(part.num_rows), np.diff(at))
                size = n.astype(np.int64) - 1 + length
                raw = data[np.repeat(offsets[row] + start, size) + runs_within(size)]
                ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                body = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([pa.array(h), part.column(1).take(pa.array(row)), part.column(2).take(pa.array(row)), pa.array(start), body], names=["h", "node", "variant", "start", "bytes"])

    return run


REPEATS = "node long, variant long, start int, n int"


def _repeats(node, variant, start, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(variant), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))], names=["node", "variant", "start", "n"])


def later_starts(node: np.ndarray, variant: np.ndarray, start: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Mask of the rows that are later than the earliest (node, start) of their group."""
    order = np.lexsort((start, node, group))
    g = group[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = g[1:] != g[:-1]
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = np.zeros(len(group), dtype=bool)
    later[order] = (node[order] != node[first]) | (start[order] != start[first])
    return later


def comparable(h: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Fragments that may share a string with another one of their anchor (h), and the first byte
    and number of bytes of each that hold all such strings.

    Equal strings have the anchor at equal distance. Distances are taken in steps of ``width``: all strings of a
    step hold the same window of length - width + 1 bytes, so a string is shared only where the window of its step is."""
    width = max(1, (length - gram + 1) // WINDOWS)
    size = np.diff(offsets)
    n = size - length + 1
    hasher = SpanHasher(data)
    grams = mix(mix((hasher.total[gram:] - hasher.total[:-gram]) * hasher.down[: len(data) - gram + 1]) + U64(1))
    owner = np.repeat(np.arange(len(size)), size)[: len(grams)]
    # The anchor is the leftmost of equal grams in the first string, so the first of its kind in the fragment.
    hit = np.flatnonzero(grams == h[owner])
    anchor = hit[np.unique(owner[hit], return_index=True)[1]] - offsets[:-1]
    near, far = (anchor - n + 1) // width, anchor // width
    count = far - near + 1
    who = np.repeat(np.arange(len(n)), count)
    step = np.repeat(near, count) + runs_within(count)
    begin = (offsets[:-1] + anchor)[who] - step * width
    key = hasher.hash(begin, begin + length - width + 1) ^ mix(h[who] + step.astype(U64))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    shared = order[np.append(same, False) | np.append(False, same)]
    nearest, farthest = np.full(len(n), length), np.full(len(n), -1)
    np.minimum.at(nearest, who[shared], step[shared])
    np.maximum.at(farthest, who[shared], step[shared])
    use = np.flatnonzero(farthest >= 0)
    first = np.maximum(anchor[use] - (farthest[use] + 1) * width + 1, 0)
    last = np.minimum(anchor[use] - nearest[use] * width, n[use] - 1)
    return use, first, last - first + length


def _sort_blocks(length: int, gram: int, block: int):
    """Repeated starts among fragments sorted by h, block by block of whole groups."""

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(parts).combine_chunks()
        body = t.column("bytes").chunk(0)
        offsets = np.frombuffer(body.buffers()[1], np.int32, len(body) + 1, body.offset * 4).astype(np.int64)
        data = np.frombuffer(body.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kept, first, n = comparable(t.column("h").to_numpy().view(U64), data, offsets, length, gram)
        if not len(kept):
            return None
        data = data[np.repeat(offsets[kept] + first, n) + runs_within(n)]
        offsets = np.concatenate(([0], np.cumsum(n)))
        owner, size, shared = suffix_order(data, offsets)
        # Runs of neighbours that share ``length`` bytes are equal strings.
        same = shared >= length
        use = np.flatnonzero(same | np.append(same[1:], False))
        if not len(use):
            return None
        group = np.cumsum(~same)[use]
        own, into = kept[owner[use]], (first + n)[owner[use]] - size[use]
        node, variant = t.column("node").to_numpy()[own], t.column("variant").to_numpy()[own]
        start = t.column("start").to_numpy()[own] + into
        later = later_starts(node, variant, start, group)
        if not later.any():
            return None
        return _repeats(*joined_runs(node[later], variant[later], start[later], np.ones(int(later.sum()), dtype=np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            h = batch.column(0).to_numpy()
            at = 0
            cuts = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h))  # ends of groups within the batch
            while at < len(h):
                later_cuts = cuts[(cuts > at) & (cuts < len(h))]
                full = later_cuts[later_cuts - at + count >= block]
                if held and count >= block and held[-1].column(0)[-1].as_py() != h[at]:
                    end = at  # the block was full, and its last group has ended
                else:
                    end = int(full[0]) if len(full) else len(h)
                if end > at:
                    held.append(batch.slice(at, end - at))
                    count += end - at
                if end < len(h) or end == at:
                    found = solve(held)
                    held, count = [], 0
                    if found is not None:
                        yield found
                at = end
        if held:
            found = solve(held)
            if found is not None:
                yield found

    return run


def _explode(length: int):
    """Every string of the fragments by its 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, node, variant, start = (batch.column(k).to_numpy() for k in range(4))
            for i, raw in enumerate(batch.column(4).to_pylist()):
                hasher = SpanHasher(np.frombuffer(raw, np.uint8))
                at = np.arange(len(raw) - length + 1)
                w1, w2 = hasher.hash(at, at + length), np.frombuffer(b"".join(hashlib.blake2b(raw[k : k + length], digest_size=8).digest() for k in at.tolist()), np.int64)
                ones = np.ones(len(at), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2), pa.array(node[i] * ones), pa.array(variant[i] * ones), pa.array((start[i] + at).astype(np.int32))], names=["w1", "w2", "node", "variant", "start"]
                )

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def covered(starts: np.ndarray, counts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that start at the given runs of starts."""
    none = np.zeros(len(starts), dtype=np.int64)
    _, _, begin, size = joined_runs(none, none, starts, counts.astype(np.int64) + length - 1)
    return [(a, a + n) for a, n in zip(begin.tolist(), size.tolist(), strict=True)]


def _remove(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                rows: list[list] = [[] for _ in range(5)]
                for i, text in enumerate(part.column(1).to_pylist()):
                    raw = (text or "").encode()
                    runs = part.column(2)[i].as_py()
                    gone = covered(np.array([r["start"] for r in runs]), np.array([r["n"] for r in runs]), length) if runs else []
                    ends = [0, *(b for _, b in gone)]
                    kept = b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(raw)], strict=True))
                    for column, value in zip(rows, (len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if with_text else None), strict=True):
                        column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(rows, kinds, strict=True))], names=[c.split()[0] for c in RESULT.split(", ")])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, largest_group: int = LARGEST_GROUP, with_text: bool = True) -> DataFrame:
    """n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes (null unless ``with_text``) of every row of docs (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("node", F.coalesce("doc_id", F.lit(LAST_ID)))
    # Ids with several texts (null among them) tell these apart by a hash of the text.
    several = stored(rows.groupBy("node").agg(F.min(F.md5(F.col("text").cast("binary"))).alias("a"), F.max(F.md5(F.col("text").cast("binary"))).alias("b")).where("a <> b").select("node", F.lit(True).alias("many")), "repeat-ids")
    keyed = rows.join(several, "node", "left").select("doc_id", "node", F.when(F.col("many"), F.xxhash64("text")).otherwise(F.lit(0)).cast("long").alias("variant"), "text")

    marks = keyed.select("node", "variant", "text").mapInArrow(_marks(length, gram), MARKS)
    sorted_marks = marks.repartition("h").sortWithinPartitions("h", "f", "node", "variant", "start")
    found = stored(sorted_marks.mapInArrow(_groups, MARKS).drop("f"), "repeat-marks")

    compare = found.where("not known")
    large = stored(compare.groupBy("h").agg(F.count("*").alias("size")).where(F.col("size") > largest_group).select("h"), "repeat-large")
    by_document = keyed.repartition("node", "variant")

    def fragments(which: DataFrame) -> DataFrame:
        # All columns of the documents are kept, needed or not: so this join and the last one read one shuffle of the texts.
        wanted = which.groupBy("node", "variant").agg(F.collect_list(F.struct("h", "start", "n")).alias("marks"))
        return by_document.select("doc_id", "node", "variant", "text").join(wanted, ["node", "variant"]).select("doc_id", "node", "variant", "text", "marks").mapInArrow(_fetch(length), FRAGMENT)

    # A group beyond ``largest_group`` holds that many fragments, so there are few such groups.
    usual = fragments(compare.join(F.broadcast(large), "h", "left_anti"))
    repeats = usual.repartition("h").sortWithinPartitions("h").mapInArrow(_sort_blocks(length, gram, block), REPEATS)
    if not large.isEmpty():
        strings = fragments(compare.join(F.broadcast(large), "h", "left_semi")).mapInArrow(_explode(length), "w1 long, w2 long, node long, variant long, start int")
        strings = stored(strings, "repeat-strings")
        earliest = strings.groupBy("w1", "w2").agg(F.min(F.struct("node", "start")).alias("first"))
        later = strings.join(earliest, ["w1", "w2"]).where((F.col("node") != F.col("first.node")) | (F.col("start") != F.col("first.start")))
        repeats = repeats.unionByName(later.select("node", "variant", "start", F.lit(1).alias("n")))
    repeats = found.where("known").select("node", "variant", "start", "n").unionByName(repeats)
    spans = repeats.groupBy("node", "variant").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = by_document.select("doc_id", "node", "variant", "text").join(spans, ["node", "variant"], "left")
    return joined.select("doc_id", "text", "runs").mapInArrow(_remove(length, with_text), RESULT)
