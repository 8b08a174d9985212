"""Toxicity by multiple-instance learning.

Only documents are labelled; a document is a bag of sentences (stretches
between line breaks, full stops, exclamation and question marks). A sentence
has probability p = sigmoid(bias + sum of the weights of its words and word beginnings), a document is
toxic unless none of its sentences is: P = 1 - prod(1 - p), the noisy-or.
Weights are fitted by gradient descent on the documents' log likelihood
through the noisy-or, so they learn which sentence carries the label; scoring
then also locates the offending sentences.

Fitting uses a bounded sample of the labelled rows: those whose id hash lies
below ``fit_documents`` / (labelled rows), ``fit_documents`` in
expectation. Its words that occur in enough documents, and in toxic ones clearly
more or less often than in others (``MIN_Z`` standard errors), are the features.
The sample is the broadcast side of the join and is fitted in one task, with one text per id (of a
repeated id, the text of the smallest xxhash64), so its rows are bounded like its ids; the
model, a hash and a weight for each of those features, comes back to the driver.
Scoring is one pass over the whole texts without a shuffle.

Defined results: null and empty texts and texts without words have no
sentence and score 0; without labelled rows of both kinds every score is 0;
several labels of one document count as their largest; several texts of one id are scored each, and one of them is
learnt from; documents without id are scored and not learnt from; labels other than 0 and 1 are
not learnt from; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.text_arrays import U64, SpanHasher, buffers, slices, word_spans

FIT_DOCUMENTS = 10_000
MIN_DOCUMENTS = 4
MIN_Z = 6.0
STEPS = 300
PENALTY = 1e-4
OFFENDING = 0.5
#: Words also count by their first so many bytes, since inflected forms are rare one by one.
PREFIXES = (4, 5)
_SAMPLE_PARTS = 1 << 24
_DELIMITERS = b"\n.!?"
_SENTENCE_END = re.compile(r"[\n.!?]")

_NOT_LETTER = np.ones(256, dtype=bool)
_NOT_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(_DELIMITERS)] = True


def sentences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and sentence number (delimiters before it in its row) of every
    feature of the column: each word, and its beginnings of PREFIXES bytes, in text order."""
    data, offsets = buffers(pc.utf8_lower(texts.fill_null("")))
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty.astype(U64), empty, empty
    starts, ends, rows = word_spans(data, offsets, _NOT_LETTER)
    seen = np.concatenate(([0], np.cumsum(_ENDS[data])))
    hasher = SpanHasher(data)
    features = [hasher.hash(starts, ends)]
    features += [hasher.hash(starts, np.minimum(starts + k, ends)) ^ U64(k) for k in PREFIXES]
    number = seen[starts] - seen[offsets[rows]]
    return np.stack(features, axis=1).ravel(), np.repeat(rows, len(features)), np.repeat(number, len(features))


@dataclass
class Model:
    words: np.ndarray  # ascending hashes
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Score of each text; row, number and probability of its sentences that hold a weighted word."""
        n = len(texts)
        hashes, rows, number = sentences(texts)
        if not len(hashes) or not len(self.words):
            none = np.zeros(0)
            return np.zeros(n), none.astype(int), none.astype(int), none
        # Sentences are runs of equal (row, number): words come in text order.
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (number[1:] != number[:-1])
        sentence = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        known = self._known(hashes)
        at = np.searchsorted(self.words, hashes[known])
        z = self.bias + np.bincount(sentence[known], weights=self.weights[at], minlength=len(first))
        p = 1 / (1 + np.exp(-z))
        none_toxic = np.bincount(rows[first], weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)
        hit = np.unique(sentence[known])
        return 1 - np.exp(none_toxic), rows[first][hit], number[first][hit], p[hit]

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        table = np.zeros(1 << 16, dtype=bool)
        table[(self.words >> U64(48)).astype(int)] = True
        maybe = np.flatnonzero(table[(hashes >> U64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.words, hashes[maybe]), len(self.words) - 1)
        return maybe[self.words[at] == hashes[maybe]]


def choose_words(chunks: Iterator[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """Ascending hashes of the features that tell toxic documents from others, from
    (hash, document) pairs in chunks of whole documents. Only counts per feature are kept."""
    n, positive = len(labels), int(labels.sum())
    words, counts = np.zeros(0, U64), np.zeros((2, 0))
    for hashes, docs in chunks:
        order = np.lexsort((hashes, docs))
        h, d = hashes[order], docs[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, toxic = h[new], labels[d[new]].astype(np.float64)
        words, place = np.unique(np.concatenate((words, h)), return_inverse=True)
        old = counts.shape[1]
        counts = np.stack([np.bincount(place, weights=np.concatenate((c, w)), minlength=len(words)) for c, w in zip(counts, (np.ones(len(h)), toxic), strict=True)])
        assert len(place) == old + len(h)
    in_any, in_toxic = counts
    rate = in_any / max(n, 1)
    z = (in_toxic - positive * rate) / np.sqrt(np.maximum(positive * rate * (1 - rate) * (1 - positive / max(n, 1)), 1e-9))
    strength = np.where(in_any >= MIN_DOCUMENTS, np.abs(z), 0)
    return words[strength >= MIN_Z]


def fit_bags(words: np.ndarray, feature: np.ndarray, inside: np.ndarray, bag: np.ndarray, labels: np.ndarray) -> Model:
    """Fit the weights of ``words``: feature[i] occurs in sentence inside[i]; bag has each sentence's document."""
    n, positive = len(labels), int(labels.sum())
    if not len(bag) or positive in (0, n):
        return Model(np.zeros(0, U64), np.zeros(0), 0.0)
    weights, bias = np.zeros(len(words)), -np.log(max(len(bag) / positive, 2.0))
    step = [np.zeros(len(words) + 1), np.zeros(len(words) + 1)]
    for t in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-(bias + np.bincount(inside, weights=weights[feature], minlength=len(bag)))))
        p = np.clip(p, 1e-9, 1 - 1e-9)
        none = np.exp(np.bincount(bag, weights=np.log1p(-p), minlength=n))
        # d log P / dz = p (1 - P) / P for toxic documents, d log(1 - P) / dz = -p for the others.
        pull = np.where(labels == 1, none / np.maximum(1 - none, 1e-9), -1.0)
        dz = p * pull[bag] / n
        gradient = np.append(np.bincount(feature, weights=dz[inside], minlength=len(words)) - PENALTY * weights, dz.sum())
        # Adam with its usual constants.
        step[0] = 0.9 * step[0] + 0.1 * gradient
        step[1] = 0.999 * step[1] + 0.001 * gradient**2
        move = 0.1 * (step[0] / (1 - 0.9**t)) / (np.sqrt(step[1] / (1 - 0.999**t)) + 1e-8)
        weights, bias = weights + move[:-1], bias + move[-1]
    return Model(words, weights, float(bias))


def fit_texts(texts: pd.Series, labels: np.ndarray, chunk: int = 500) -> Model:
    """Two passes over the texts in chunks: choose the words, then gather their occurrences and fit."""
    if not len(texts):
        return Model(np.zeros(0, U64), np.zeros(0), 0.0)
    parts = lambda: ((i, *sentences(pa.array(texts.iloc[i : i + chunk], pa.large_string()))) for i in range(0, len(texts), chunk))
    words = choose_words(((h, d + i) for i, h, d, _ in parts()), labels)
    features, inside, bags, count = [], [], [], 0
    for i, hashes, docs, number in parts():
        new = np.ones(len(docs), dtype=bool)
        new[1:] = (docs[1:] != docs[:-1]) | (number[1:] != number[:-1])
        sentence = np.cumsum(new) - 1 + count
        at = np.minimum(np.searchsorted(words, hashes), max(len(words) - 1, 0))
        known = words[at] == hashes if len(words) else np.zeros(len(hashes), dtype=bool)
        features.append(at[known])
        inside.append(sentence[known])
        bags.append(docs[new] + i)
        count += int(new.sum())
    return fit_bags(words, np.concatenate(features), np.concatenate(inside), np.concatenate(bags), labels)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, fit_documents: int = FIT_DOCUMENTS) -> Model:
    """Fit on the documents with a label in ``labels`` (doc_id, toxic) where ``learn`` (over doc_id) holds."""
    labels = labels.where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    labels = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = labels.count()
    below = min(_SAMPLE_PARTS, fit_documents * _SAMPLE_PARTS // max(n, 1) + 1)
    sample = labels.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(_SAMPLE_PARTS)) < below)
    # Bounded by fit_documents, hence broadcast: the texts are not shuffled to find the sample.
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    chosen = chosen.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("kept")).select("doc_id", "kept.text", "toxic")

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"]).reset_index(drop=True)
        model = fit_texts(pdf["text"], pdf["toxic"].to_numpy())
        return pd.DataFrame({"word": np.append(model.words.astype(np.int64), 0), "weight": np.append(model.weights, model.bias), "is_bias": [False] * len(model.words) + [True]})

    found = chosen.groupBy().applyInPandas(train, "word long, weight double, is_bias boolean").collect()
    bias = next((r.weight for r in found if r.is_bias), 0.0)
    found = [r for r in found if not r.is_bias]
    return Model(np.array([r.word for r in found], dtype=np.int64).astype(U64), np.array([r.weight for r in found]), bias)


def spans_of(text: str, numbers: list[int]) -> list[tuple[int, int]]:
    """Start and end (code points) of the sentences with these numbers, blanks around them left out."""
    ends = [m.start() for m in _SENTENCE_END.finditer(text)] + [len(text)]
    out = []
    for k in numbers:
        start, end = (ends[k - 1] + 1 if k else 0), ends[k]
        piece = text[start:end]
        out.append((start + len(piece) - len(piece.lstrip()), start + len(piece.rstrip())))
    return out


SCORED = "doc_id long, score double, n_offending long, offending array<struct<start:int,end:int,p:double>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_offending, and the offending sentences (p of at least OFFENDING) as code point spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            for part in slices(batch):
                found, rows, number, p = model.score(part.column(1))
                bad: list[list[dict]] = [[] for _ in range(part.num_rows)]
                loud = p >= OFFENDING
                for i in np.unique(rows[loud]).tolist():
                    here = loud & (rows == i)
                    spans = spans_of(part.column(1)[i].as_py(), number[here].tolist())
                    bad[i] = [{"start": a, "end": b, "p": x} for (a, b), x in zip(spans, p[here].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found), pa.array(map(len, bad), pa.int64()), pa.array(bad, kind)], names=["doc_id", "score", "n_offending", "offending"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCORED)
