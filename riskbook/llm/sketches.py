"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

A text's sketch holds all distinct hashes of its five-word shingles below
2**64 / SCALE, so the sketches of two texts hold the same sample of the shingles
they share, however unequal their lengths; the sketch of a union is the union of the
sketches. A text of at most FULL_SHINGLES distinct shingles, of which such a sample would say nothing,
keeps them all (fraction 1), and so does one whose sample would be empty; compared with a sampled one, both are first cut to the
smaller fraction, so the estimates stay those of one threshold. As text a
fingerprint is the inverse fraction, a colon, and 16 hexadecimal digits per hash in
ascending order.

Defined results: null text is empty; a text without words has the fingerprint
"1:"; a text of one to four words has one shingle. Two equal fingerprints have
likeness 1, also "1:" twice; otherwise likeness is shared hashes over all
hashes (Jaccard), 0 where neither holds any at the smaller fraction. Containment
of a text without words is 1, and null where the cut to the smaller fraction leaves
nothing of a text that has some.

:func:`with_next` pairs each document with the next one in descending doc_id in one range
shuffle of the texts, without a global window: documents go to id ranges, and the first document of each
range is also sent to the end of the range before it. Repeated doc_ids follow
one another in order of their text's xxhash64, then text; null ids come last. An id (or none) that fills whole ranges is cut
further by that hash, and equal rows, which are interchangeable, by any number. A single document is
its own next one.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.text_arrays import buffers, shingles, slices

SCALE = 8
FULL_SHINGLES = 64
SAMPLE_PER_RANGE = 64
MOST_PIECES = 1 << 20  # of the rows of one id; there are never more than ranges
_SAMPLE_PARTS = 1 << 31


class Sketch:
    """Sorted distinct hashes below 2**64 / scale."""

    __slots__ = ("hashes", "scale")

    def __init__(self, hashes: np.ndarray, scale: int):
        self.hashes, self.scale = hashes, scale

    def at(self, scale: int) -> np.ndarray:
        """The hashes below a smaller (or the same) fraction."""
        return self.hashes if scale == self.scale else self.hashes[: np.searchsorted(self.hashes, np.uint64((1 << 64) // scale))]

    def text(self) -> str:
        return f"{self.scale}:{self.hashes.astype('>u8').tobytes().hex()}"

    @classmethod
    def parse(cls, text: str) -> Sketch:
        scale, _, digits = text.partition(":")
        return cls(np.frombuffer(bytes.fromhex(digits), ">u8").astype(np.uint64), int(scale))


def shared(a: Sketch, b: Sketch) -> tuple[int, int, int]:
    """Hashes in both, in a, and in b, at the smaller fraction of the two."""
    scale = max(a.scale, b.scale)
    x, y = a.at(scale), b.at(scale)
    if not len(x) or not len(y):
        return 0, len(x), len(y)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum()), len(x), len(y)


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated Jaccard similarity of the shingle sets."""
    both, n, m = shared(a, b)
    if n + m - both == 0 or (both == n == m and a.scale == b.scale):
        # Two empty samples say nothing; only texts without words are known to be equal.
        return float(a.scale == b.scale and (n > 0 or a.scale == 1))
    return both / (n + m - both)


def containment(a: Sketch, b: Sketch) -> float | None:
    """Estimated share of a's shingles that b has; 1 if a has none, None if the common fraction holds none of them."""
    both, n, _ = shared(a, b)
    if n:
        return both / n
    return 1.0 if a.scale == 1 and not len(a.hashes) else None


def merge(a: Sketch, b: Sketch) -> Sketch:
    """Sketch of the union of both shingle sets."""
    scale = max(a.scale, b.scale)
    return Sketch(np.union1d(a.at(scale), b.at(scale)), scale)


def sketches(column: pa.Array, scale: int = SCALE, full: int = FULL_SHINGLES) -> list[Sketch]:
    data, offsets = buffers(column)
    hashes, rows = shingles(data, offsets)
    n = len(offsets) - 1
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    low = hashes < np.uint64((1 << 64) // scale) if scale > 1 else np.ones(len(hashes), dtype=bool)
    # A sample of few distinct shingles says nothing, an empty one even less: those texts keep all.
    all_kept = (np.bincount(rows, minlength=n) <= full) | (np.bincount(rows[low], minlength=n) == 0)
    keep = low | all_kept[rows]
    hashes, rows = hashes[keep], rows[keep]
    at = np.searchsorted(rows, np.arange(n + 1))
    return [Sketch(hashes[at[i] : at[i + 1]], 1 if all_kept[i] else scale) for i in range(n)]


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """doc_id, fingerprint of every document; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.text() for s in sketches(part.column(1), scale)], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def _cuts_of_hot_ids(hot: DataFrame, total: int, n: int) -> dict[int | None, list[tuple[int, int]]]:
    """Ascending (hash, salt) cuts of the rows ``hot`` (doc_id, hash, salt), about ``total`` / ``n`` rows apart; what is
    collected are SAMPLE_PER_RANGE keys of three numbers a range."""
    below = min(_SAMPLE_PARTS, SAMPLE_PER_RANGE * n * _SAMPLE_PARTS // max(total, 1) + 1)
    keys: dict[int | None, list[tuple[int, int]]] = {}
    for r in hot.where(F.pmod(F.xxhash64("doc_id", "hash", "salt"), F.lit(_SAMPLE_PARTS)) < below).collect():
        keys.setdefault(r.doc_id, []).append((r.hash, r.salt))
    return {k: sorted(v)[SAMPLE_PER_RANGE - 1 :: SAMPLE_PER_RANGE] for k, v in keys.items()}


def in_id_ranges(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) with hash (xxhash64 of the text) and bucket: numbers of ranges in descending doc_id (null
    last), hash, of about equally many rows each."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    cuts, times = np.unique(np.array(found, dtype=np.float64), return_counts=True)
    hashed = lambda df: df.withColumn("hash", F.xxhash64("text"))
    salted = lambda df: hashed(df).withColumn("salt", F.monotonically_increasing_id())
    hot: dict[int | None, list[tuple[int, int]]] = {}
    counts = rows.agg(F.count("*").alias("total"), F.count("doc_id").alias("ids")).first()
    many = [int(c) for c in cuts[times > 1]]
    no_id = n * (counts.total - counts.ids) > 2 * counts.total
    if many or no_id:
        # An id with several quantiles, at most n / 2 of them, or none in more rows than two ranges hold.
        wanted = F.col("doc_id").isin(many) | (F.lit(no_id) & F.col("doc_id").isNull())
        hot = _cuts_of_hot_ids(salted(rows.where(wanted)).select("doc_id", "hash", "salt"), counts.total, n)

    def numbers(ids: pd.Series) -> np.ndarray:
        number = len(cuts) - np.searchsorted(cuts, ids.fillna(0).to_numpy(dtype=np.float64))
        # A cut is the largest id of its range: with cuts of its own it is a range before the rest.
        number = 2 * np.where(ids.isna(), len(cuts) + 1, number) + ~np.isin(ids.fillna(0), [k for k in hot if k is not None])
        return number.astype(np.int64) * MOST_PIECES

    @F.pandas_udf("long")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(numbers(ids))

    @F.pandas_udf("long")
    def bucket_and_piece(ids: pd.Series, hashes: pd.Series, salts: pd.Series) -> pd.Series:
        own = [hot.get(None if pd.isna(i) else int(i)) for i in ids]
        return pd.Series(numbers(ids) + [0 if c is None else bisect_right(c, (h, s)) for c, h, s in zip(own, hashes, salts, strict=True)])

    if hot:
        return salted(rows).withColumn("bucket", bucket_and_piece("doc_id", "hash", "salt")).drop("salt")
    return hashed(rows).withColumn("bucket", bucket("doc_id"))


def with_next(docs: DataFrame, each: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``each`` over runs of documents in descending doc_id: a table with doc_id,
    text and next_text (the next document's text; the first one's after the last)."""
    spark = docs.sparkSession
    rows = in_id_ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    # One row per range: the ranges that hold documents and the first id of each.
    firsts = rows.groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect()
    if not firsts:
        return spark.createDataFrame([], schema)
    heads = spark.createDataFrame([(firsts[i - 1].bucket, r.head, r.bucket) for i, r in enumerate(firsts)], "closes long, head long, of long")
    closing = rows.join(F.broadcast(heads), (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("head")))
    # The first id's first row, one per range; a repeated id is reduced to it map-side.
    closing = closing.groupBy(F.col("closes").alias("bucket"), "doc_id").agg(F.min(F.struct("hash", "text")).alias("first"))
    closing = closing.select("doc_id", "first.text", "first.hash", "bucket", F.lit(1).alias("closing"))
    both = rows.withColumn("closing", F.lit(0)).unionByName(closing)
    ordered = both.repartitionByRange("bucket").sortWithinPartitions("bucket", "closing", F.desc_nulls_last("doc_id"), "hash", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last document, which waits for its next one
        for batch in batches:
            for part in slices(batch, "text"):
                t = pa.Table.from_batches([part])
                t = pa.concat_tables([held, t]) if held is not None else t
                own = np.flatnonzero(t.column("closing").to_numpy() == 0)
                ready = own[own < t.num_rows - 1]
                if len(ready):
                    texts = t.column("text")
                    yield each(pa.table({"doc_id": t.column("doc_id").take(pa.array(ready)), "text": texts.take(pa.array(ready)), "next_text": texts.take(pa.array(ready + 1))}))
                held = t.slice(t.num_rows - 1)

    return ordered.select("doc_id", "text", "closing").mapInArrow(run, schema)


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_of_text double"


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint against those of its edited text (second half
    replaced by the beginning of the next document) and of the next document."""

    def each(t: pa.Table) -> pa.RecordBatch:
        texts, following = t.column("text").to_pylist(), t.column("next_text").to_pylist()
        edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, following, strict=True)]
        own, after, changed = (sketches(x) for x in (t.column("text"), t.column("next_text"), pa.array(edited, pa.large_string())))
        return pa.RecordBatch.from_arrays(
            [
                t.column("doc_id").combine_chunks(),
                pa.array(map(len, texts), pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
                pa.array([s.text() for s in own], pa.string()),
                pa.array([s.text() for s in changed], pa.string()),
                pa.array(map(likeness, own, changed), pa.float64()),
                pa.array(map(likeness, own, after), pa.float64()),
                pa.array(map(containment, own, changed), pa.float64()),
            ],
            names=[c.split()[0] for c in EDITED.split(", ")],
        )

    return with_next(docs, each, EDITED)
