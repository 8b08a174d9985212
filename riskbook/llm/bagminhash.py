"""Near-duplicate documents by BagMinHash.

A document is the multiset of its five-word shingles; the similarity of two
documents is the weighted Jaccard index of their multisets. Documents with
similarity of at least ``threshold`` are linked, and classes are what links
connect.

Signatures. Every shingle has, for each dyadic range of weights [0,1), [1,2),
[2,4), [4,8), ..., a Poisson process of points seeded by shingle and range, whose
rate is the length of the range. A point has a time, one of the signature's
places, and a weight within its range. A document whose weight of the
shingle is w receives the points below w: all of the ranges below it, and in the range that
w divides those that the halving of the range, down to unit weights, puts below w. A place of the signature is the earliest
time of the points that fall on it. As equal weights share equal points, two
places agree with probability equal to the weighted Jaccard index: unbiased.
Only points that can still beat the slowest place are made, so a document of n shingles and m
places takes about n + m log m of them.

Candidates. The places are cut in bands; documents that agree on a band share
a bucket, and each is linked to the smallest document of the bucket. The components
of those links are candidate groups, far smaller than the corpus.

Verification. All pairs within a candidate group are held against the exact
multiset overlap, in one task per group of up to ``block`` texts: shared shingles are
counted through inverted lists, and only a spanning forest of the links leaves the task. A larger
group is cut into blocks, and each pair of blocks is a task of its own, so no
task ever holds more than two blocks and no link is lost; blocks that turn out alike are
linked through their forests. Equal texts never get here: one representative stands for all.

Shuffles: text hashes (to find equal texts), band keys, and the texts of candidate groups only.

Defined results: null text counts as empty, and all empty texts are copies of
one another; a text of one to four words has one shingle; the class of a
document is the smallest doc_id in it, ``kept`` marks one row of each class (the first
row with that doc_id); rows with equal doc_id are one document and belong to
one class; rows with null doc_id take part with a negative stand-in id derived from
their text; extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import stored
from riskbook.llm.components import components
from riskbook.llm.text_arrays import U64, buffers, mix, runs_within, shingles, slices

THRESHOLD = 0.8
BANDS, BAND_ROWS = 28, 7
BLOCK, BLOCK_BYTES = 2048, 32 << 20
_GOLDEN = U64(0x9E3779B97F4A7C15)


def bags(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) pairs in that order, and how often each occurs."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(new)
    return h[first], r[first], np.diff(np.append(first, len(h)))


def signatures(hashes: np.ndarray, rows: np.ndarray, weights: np.ndarray, n: int, places: int) -> np.ndarray:
    """BagMinHash of n documents given as (hash, row, integer weight); infinite for a document without shingles."""
    sig = np.full((n, places), np.inf)
    if not len(hashes):
        return sig
    # One process per dyadic range that the weight reaches: range 0 is [0,1), range k is [2**(k-1), 2**k).
    levels = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64), 0) + 1
    level = runs_within(levels)
    key, row, weight = np.repeat(hashes, levels), np.repeat(rows, levels), np.repeat(weights, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    length = np.maximum(low, 1)
    seed = mix(key ^ (level.astype(U64) + U64(1)) * _GOLDEN)
    # Rate: per unit of weight one point per unit of time, thrown on any place.
    time = np.zeros(len(seed))
    step = 0
    flat = sig.reshape(-1)
    # Elements go through their points in order of time; those past their document's slowest place stop.
    chunk = 1
    while len(seed):
        counter = (U64(step) + np.arange(chunk, dtype=U64)) * U64(2) + U64(1)
        a = mix(seed[:, None] ^ counter * U64(0xA0761D6478BD642F))
        b = mix(a + _GOLDEN)
        gaps = -np.log1p(-((a >> U64(11)).astype(np.float64) * 2.0**-53)) / length[:, None]
        # Added one by one from the last time on: a point's time must not depend on where chunks begin.
        times = np.cumsum(np.concatenate((time[:, None], gaps), axis=1), axis=1)[:, 1:]
        place = (b >> U64(40)).astype(np.int64) % places
        # Unit of weight within the range by repeated halving: the high bits of a random number.
        unit = low[:, None] + ((b & U64((1 << 32) - 1)).astype(np.int64) * length[:, None] >> 32)
        valid = unit < weight[:, None]
        np.minimum.at(flat, (row[:, None] * places + place)[valid], times[valid])
        time = times[:, -1]
        step += chunk
        slowest = sig.max(axis=1)
        go = time <= slowest[row]
        seed, time, row, weight, low, length = (x[go] for x in (seed, time, row, weight, low, length))
        # Few elements left: more points of each at a time.
        chunk = int(np.clip(200_000 // max(len(seed), 1), 1, 64))
    return sig


def band_keys(texts: pa.Array, bands: int = BANDS, band_rows: int = BAND_ROWS) -> np.ndarray:
    """Keys of the bands of each text's signature; texts without words agree in all of them."""
    data, offsets = buffers(texts)
    h, r, w = bags(*shingles(data, offsets))
    sig = signatures(h, r, w, len(offsets) - 1, bands * band_rows).view(U64)
    keys = np.zeros((len(sig), bands), dtype=U64)
    for j in range(band_rows):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + sig[:, j::band_rows][:, :bands] + U64(j))
    return mix(keys + np.arange(bands, dtype=U64) * _GOLDEN).view(np.int64)


def linked(texts: list[str], left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the links between texts i in ``left`` and j in ``right``
    (masks) whose weighted Jaccard index is at least ``threshold``."""
    data, offsets = buffers(pa.array(texts, pa.large_string()))
    h, r, w = bags(*shingles(data, offsets))
    n = len(texts)
    size = np.bincount(r, weights=w, minlength=n)
    # Inverted lists of the right-hand texts.
    words, word = np.unique(h, return_inverse=True)
    on_right = right[r]
    order = np.argsort(word[on_right], kind="stable")
    doc, count = r[on_right][order], w[on_right][order]
    begin = np.searchsorted(word[on_right][order], np.arange(len(words) + 1))
    at = np.searchsorted(r, np.arange(n + 1))
    tree, out = np.arange(n), []  # tree: label of each text's part of the forest
    for i in np.flatnonzero(left).tolist():
        if not ((tree != tree[i]) & right).any():
            continue
        own, mine = word[at[i] : at[i + 1]], w[at[i] : at[i + 1]]
        lists = begin[own + 1] - begin[own]
        where = np.repeat(begin[own], lists) + runs_within(lists)
        both = np.bincount(doc[where], weights=np.minimum(count[where], np.repeat(mine, lists)), minlength=n)
        near = (both >= threshold * (size[i] + size - both) - 1e-9) & right & ((size > 0) | (size[i] == 0))
        while True:
            other = np.flatnonzero(near & (tree != tree[i]))
            if not len(other):
                break
            j = int(other[0])
            out.append((i, j))
            tree[tree == tree[j]] = tree[i]
    return out


def document_key(docs: DataFrame) -> DataFrame:
    """docs with node (doc_id, or for null a negative number made from the text) and
    h1, h2 (two 60-bit halves of the text's md5; null text is empty)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(text.cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    node = F.coalesce(F.col("doc_id").cast("long"), -1 - F.shiftrightunsigned(F.xxhash64(text), 1))
    return docs.withColumns({"node": node, "h1": half(1), "h2": half(17)})


def text_classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, band_rows: int = BAND_ROWS, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """h1, h2, copy_of, class_id: one row for every distinct text of docs (doc_id, text)."""
    rows = document_key(docs.select("doc_id", "text")).select("node", "h1", "h2", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    names = ["node", "h1", "h2", "n_bytes", "keys"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                _, offsets = buffers(part.column(3))
                keys = pa.array(band_keys(part.column(3), bands, band_rows).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, bands, dtype=np.int32)), keys)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.diff(offsets), pa.int64()), lists], names=names)

    signed = rows.mapInArrow(sign, "node long, h1 long, h2 long, n_bytes long, keys array<long>")
    # One row per text: copies combine in the tasks that read them, before the shuffle.
    texts = signed.groupBy("h1", "h2").agg(F.min("node").alias("copy_of"), F.any_value("n_bytes").alias("n_bytes"), F.any_value("keys").alias("keys"))
    texts = stored(texts, "near-texts")

    banded = texts.select(F.col("copy_of").alias("node"), F.posexplode("keys").alias("band", "key"))
    leaders = banded.groupBy("band", "key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last")
    star = banded.join(leaders, ["band", "key"]).where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    groups = stored(components(star), "near-groups")

    # Groups within a block are one task each; of larger ones, each pair of blocks is.
    members = texts.select(F.col("copy_of").alias("node"), "h1", "h2", "n_bytes").join(groups, "node")
    sizes = members.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n_bytes") / block_bytes)).cast("int").alias("blocks"))
    spread = members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node", "h1"), F.col("blocks")).cast("int"))
    bodies = rows.join(spread.drop("n_bytes"), ["node", "h1", "h2"]).dropDuplicates(["node", "h1", "h2"])
    paired = bodies.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "text"
    )

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["node", "text"]).reset_index(drop=True)
        own, lo, hi = pdf["own"].to_numpy(), pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        found = linked(pdf["text"].tolist(), own == lo, own == hi, threshold)
        node = pdf["node"].to_numpy()
        return pd.DataFrame({"a": node[[i for i, _ in found]], "b": node[[j for _, j in found]]}, dtype="int64")

    links = paired.groupBy("component", "lo", "hi").applyInPandas(verify, "a long, b long")
    # A document of several texts is one document: its texts are in one class.
    several = document_key(docs.select("doc_id", "text")).select("node", "h1", "h2").distinct().join(texts.select("h1", "h2", "copy_of"), ["h1", "h2"])
    several = several.groupBy("node").agg(F.min("copy_of").alias("a"), F.collect_set("copy_of").alias("all")).where(F.size("all") > 1)
    links = links.unionByName(several.select("a", F.explode("all").alias("b")).where("a <> b"))
    classes = stored(components(links), "near-classes")
    return texts.select("h1", "h2", "copy_of").join(classes.withColumnRenamed("node", "copy_of"), "copy_of", "left").select("h1", "h2", "copy_of", F.coalesce("component", "copy_of").alias("class_id"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, copy_of (smallest id with the same text), class_id (smallest id of the
    class), kept (whether the row is the document that stands for its class)."""
    classes = text_classes(docs, threshold)
    rows = document_key(docs.select("doc_id", "text")).select("doc_id", "node", "h1", "h2")
    return rows.join(classes, ["h1", "h2"]).select("doc_id", "copy_of", "class_id", (F.col("node") == F.col("class_id")).alias("kept"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that stand for their class, one row per class, all columns kept."""
    chosen = text_classes(docs, threshold).where("copy_of = class_id").groupBy("class_id").agg(F.min(F.struct("h1", "h2")).alias("h"))
    chosen = chosen.select(F.col("class_id").alias("_node"), F.col("h.h1").alias("_h1"), F.col("h.h2").alias("_h2"))
    keyed = document_key(docs.select("doc_id", "text", F.struct("*").alias("_row"))).select("_row", F.col("node").alias("_node"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
    keys = ["_node", "_h1", "_h2"]
    return keyed.join(chosen, keys, "left_semi").dropDuplicates(keys).select("_row.*")
