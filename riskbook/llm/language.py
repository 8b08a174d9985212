"""Language identification by nearest centroid.

A text's vector counts its letter n-grams (two and three UTF-8 bytes of the
lower-cased text, everything but letters read as one blank, hashed to DIMENSIONS
places), as log(1 + count) times inverse document frequency, scaled to length 1.
Each language is described by several centroids, since text of one language
falls into kinds (prose, lists, shouting); a text gets the language of the
centroid with the largest cosine, which is its score.

Fitting: document frequencies come from all learning rows. Centroids come
from a bounded sample of them: rows whose id hash lies below
``fit_per_language`` / (rows of that language), which is ``fit_per_language``
documents per language in expectation; each language's sample is clustered by
spherical k-means in one task. What reaches the driver is DIMENSIONS counts, one row count and
``centroids`` vectors per language.

Rejection: every language has a floor for short texts (under SHORT_NGRAMS n-grams) and one for
the others: the FLOOR_QUANTILE of the cosines of its own learning rows, all of them, to its centroids,
times FLOOR_MARGIN, since the rows that centroids were fitted on lie nearer to them than new text. The quantile comes
from a histogram of FLOOR_BINS steps, so single odd or mislabelled rows do not move it. A language with
fewer than 1 / FLOOR_QUANTILE rows of a kind of length takes the floor over all languages where that is lower; without
any row of that kind, it is FLOOR_FACTOR times the other kind's. A text below the
floor of its nearest centroid's language, without letters, or null is rejected. The classification itself is not
touched by that: ``lang_pred`` is the nearest language for any text with letters.

Defined results: null text and text without a letter get ``und`` and score 0;
so does every text where no labelled row exists. Among equal cosines the
language first in code point order wins. Repeated rows are predicted alike, extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.text_arrays import buffers, row_of, slices

DIMENSIONS = 4096
FIT_PER_LANGUAGE = 1500
CENTROIDS = 4
ROUNDS = 12
FLOOR_FACTOR = 0.35
FLOOR_QUANTILE, FLOOR_MARGIN, FLOOR_BINS = 0.005, 0.5, 1000
SHORT_NGRAMS = 256
UNKNOWN = "und"
_SAMPLE_PARTS = 1 << 24

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def ngram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed letter n-grams, one row of DIMENSIONS per text."""
    import pyarrow.compute as pc

    lowered = pc.utf8_lower(texts.fill_null(""))
    data, offsets = buffers(lowered)
    n = len(offsets) - 1
    if not len(data):
        return np.zeros((n, DIMENSIONS), np.float32)
    letter = _LETTER[data]
    first = np.zeros(len(data), dtype=bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    # Runs of anything else shrink to one blank; a row always begins with one.
    before = np.concatenate(([False], letter[:-1]))
    keep = letter | (before & ~first)
    kept = np.where(letter, data, 0x20)[keep].astype(np.uint32)
    rows = row_of(np.flatnonzero(keep), offsets)
    if not len(kept):
        return np.zeros((n, DIMENSIONS), np.float32)
    same = np.zeros(len(kept), dtype=bool)
    same[1:] = rows[1:] == rows[:-1]
    one = np.where(same, np.concatenate(([0x20], kept[:-1])), 0x20).astype(np.uint32)
    two = np.where(same, np.concatenate(([0x20], one[:-1])), 0x20).astype(np.uint32)
    shift = np.uint32(32 - (DIMENSIONS.bit_length() - 1))
    pairs = ((kept + (one << np.uint32(8))) * np.uint32(0x9E3779B1)) >> shift
    triples = ((kept + (one << np.uint32(8)) + (two << np.uint32(16)) + np.uint32(1 << 24)) * np.uint32(0x85EBCA6B)) >> shift
    at = rows * DIMENSIONS
    counts = np.bincount(at + pairs, minlength=n * DIMENSIONS) + np.bincount(at + triples, minlength=n * DIMENSIONS)
    return counts.reshape(n, DIMENSIONS).astype(np.float32)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    return v / np.where(norm > 0, norm, 1)[:, None]


def cluster(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; the first centre is the mean direction, each further one the vector farthest from all before."""
    centres = [vectors.mean(axis=0)]
    best = np.full(len(vectors), -1.0, dtype=np.float32)
    for _ in range(min(k, len(vectors)) - 1):
        best = np.maximum(best, vectors @ (centres[-1] / max(np.linalg.norm(centres[-1]), 1e-12)))
        centres.append(vectors[int(np.argmin(best))])
    c = np.array(centres, dtype=np.float32)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = np.argmax(vectors @ c.T, axis=1)
        c = np.array([vectors[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))], dtype=np.float32)
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    floors: np.ndarray  # of each centroid's language, for other and for short texts
    idf: np.ndarray


def fit(docs: DataFrame, learn: Column, fit_per_language: int = FIT_PER_LANGUAGE, centroids: int = CENTROIDS) -> Model:
    """Centroids of every language among the rows where ``learn`` holds; docs has doc_id, text, lang."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for part in slices(batch):
                df += (ngram_counts(part.column(0)) > 0).sum(axis=0)
                n += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMENSIONS), pa.int32()), pa.array(np.append(n, df), pa.int64())], names=["place", "n"])

    # One partial count per task and place; DIMENSIONS + 1 sums come back.
    total = {r.place: r.n for r in rows.select("text").mapInArrow(frequencies, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()}
    n = total.get(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([total.get(i, 0) for i in range(DIMENSIONS)]))).astype(np.float32) + np.float32(1)
    per_language = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per_language:
        return Model([], np.zeros((0, DIMENSIONS), np.float32), np.zeros((0, 2)), idf)
    share = rows.sparkSession.createDataFrame([(k, min(_SAMPLE_PARTS, fit_per_language * _SAMPLE_PARTS // v + 1)) for k, v in per_language.items()], "lang string, below long")
    place = F.pmod(F.xxhash64(F.lit("fit"), "doc_id", "text"), F.lit(_SAMPLE_PARTS))
    # One row per language, made from the counts above: the texts are not shuffled to find the sample.
    sample = rows.join(F.broadcast(share), "lang").where(place < F.col("below")).select("lang", "doc_id", "text")

    def centres(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"])
        counts = [ngram_counts(pa.array(pdf["text"].iloc[i : i + 200], pa.large_string())) for i in range(0, len(pdf), 200)]
        vectors = unit_vectors(np.concatenate(counts), idf)
        vectors = vectors[np.einsum("ij,ij->i", vectors, vectors) > 0]
        if not len(vectors):
            return pd.DataFrame({"lang": [], "number": [], "centroid": []})
        c = cluster(vectors, centroids)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "number": range(len(c)), "centroid": list(c)})

    found = sample.groupBy("lang").applyInPandas(centres, "lang string, number int, centroid array<float>").collect()
    found.sort(key=lambda r: (r.lang, r.number))
    matrix = np.array([r.centroid for r in found], dtype=np.float32).reshape(-1, DIMENSIONS)
    of = [r.lang for r in found]

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(of, dtype=object)
        for batch in batches:
            for part in slices(batch):
                counts = ngram_counts(part.column(1))
                own = names[None, :] == np.array(part.column(0).to_pylist(), dtype=object)[:, None]
                cosine = np.where(own, unit_vectors(counts, idf) @ matrix.T, -1).max(axis=1, initial=-1)
                bins = (np.clip(cosine, 0, 1) * FLOOR_BINS).astype(np.int32)
                # Text without letters is rejected anyway.
                read = (counts.sum(axis=1) > 0) & (cosine >= 0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(is_short(counts)), pa.array(bins)], names=["lang", "short", "bin"]).filter(pa.array(read))

    # At most 2 x (FLOOR_BINS + 1) counts per language come back.
    seen = rows.select("lang", "text").mapInArrow(cosines, "lang string, short boolean, bin int").groupBy("lang", "short", "bin").agg(F.count("*").alias("n")).collect()
    return Model(of, matrix, floors_of(of, [(r.lang, r.short, r.bin, r.n) for r in seen]), idf)


def is_short(counts: np.ndarray) -> np.ndarray:
    return counts.sum(axis=1) < SHORT_NGRAMS


def floors_of(languages: list[str], seen: list[tuple[str, bool, int, int]]) -> np.ndarray:
    """Floors (other, short texts) of each language from its histogram rows (language, short, bin, rows)."""

    def quantile(short: bool, lang: str | None = None) -> tuple[float, int]:
        bins = sorted((b, n) for x, s, b, n in seen if s == short and lang in (None, x))
        if not bins:
            return np.inf, 0
        below = np.cumsum([n for _, n in bins])
        return FLOOR_MARGIN * bins[int(np.searchsorted(below, FLOOR_QUANTILE * below[-1], "right"))][0] / FLOOR_BINS, int(below[-1])

    pooled = {short: quantile(short)[0] for short in (False, True)}

    def floor(lang: str, short: bool) -> float:
        own, n = quantile(short, lang)
        low = own if n * FLOOR_QUANTILE >= 1 else min(own, pooled[short])
        if np.isfinite(low):
            return low
        return FLOOR_FACTOR * pooled[not short] if np.isfinite(pooled[not short]) else 0.0

    by = {x: (floor(x, False), floor(x, True)) for x in set(languages)}
    return np.array([by[x] for x in languages]).reshape(-1, 2)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs with lang_pred, score, rejected; ``docs`` has text and any other columns."""
    names = sorted(set(model.languages))
    code = np.array([names.index(x) for x in model.languages], dtype=int)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    at = keep.index("text")
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                text = part.column(at)
                counts = ngram_counts(text)
                readable = np.array([t is not None and any(map(str.isalpha, t)) for t in text.to_pylist()], dtype=bool)
                readable &= bool(len(names))
                if len(names):
                    cosine = unit_vectors(counts, model.idf) @ model.centroids.T
                    best = np.stack([cosine[:, code == k].max(axis=1) for k in range(len(names))], axis=1)
                    score = np.clip(best.max(axis=1), 0, 1).astype(np.float64)
                    lang = np.array(names, dtype=object)[best.argmax(axis=1)]
                    low = score < model.floors[cosine.argmax(axis=1), is_short(counts).astype(int)]
                else:
                    score, lang, low = np.zeros(len(text)), np.full(len(text), UNKNOWN, dtype=object), np.zeros(len(text), dtype=bool)
                lang = np.where(readable, lang, UNKNOWN)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang, pa.string()), pa.array(np.where(readable, score, 0.0)), pa.array(~readable | low)], schema=pa.schema([*part.schema, pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("rejected", pa.bool_())])
                )

    return docs.select(*keep).mapInArrow(run, schema)
