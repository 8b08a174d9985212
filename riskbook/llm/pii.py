"""Personal data: pattern spans, and a skip-chain conditional random field around them.

Base spans are e-mail addresses, IPv4 addresses, card numbers and phone numbers in
international form, found by patterns (leftmost, non-overlapping per kind) and kept if they
pass the kind's test. The field then labels the other tokens that hold a digit or an @, and tokens alike to
one of those (the name before an address's @, written alone). It runs in every text that has any.
Its nodes are those tokens; its potentials are

* unary: shape of the token and of the tokens beside it;
* chain: labels of neighbouring tokens (a phone number is several);
* skip: labels of distant tokens that are alike (equal up to case and
  punctuation, or with the same first part of at least six characters). Alike tokens form a chain
  from occurrence to occurrence, so links grow with the tokens, not with their pairs.

Tokens of base spans have known labels; loopy belief propagation carries
them along the links, so a token that repeats a known one is labelled like it
anywhere in the document. A token that skip links join to one known to be of its most likely kind, where that kind reaches ``MIN_BELIEF``,
adds a span; base spans always stay.

Fitting maximises the pseudo-likelihood of the base labels on a bounded sample:
the documents with a digit or @ whose id hash lies below ``fit_documents`` /
(such documents), ``fit_documents`` in expectation, in one task. Finding is one
pass over the whole texts without a shuffle.

Defined results: null and empty texts have no spans (base_sha256 is that of the empty
string); without any base span in the sample nothing is added; a token belongs to
one document, repeated rows give equal results; a null doc_id is kept, and counts as an empty id when the sample
is drawn; repeated rows of the sample are learnt from once; extra columns are ignored.
All patterns run in time linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.text_arrays import slices

KINDS = ("email", "ip", "card", "phone")
FIT_DOCUMENTS = 4_000
STEPS = 250
PENALTY = 1e-3
ROUNDS = 10
MIN_BELIEF = 0.8
#: Prior of the skip potentials: what two alike tokens gain by equal labels, before the data speak.
AGREEMENT = 4.0
LIKE_CHARS = 6
_SAMPLE_PARTS = 1 << 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits: if the run's start fails, so does the rest of it.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_SIGN = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")
_PLAIN = re.compile(r"[^0-9a-z]+")
_HEAD = re.compile(r"[^@(\[]*")
_TRIM = re.compile(r"[0-9A-Za-z+](?:.*[0-9A-Za-z])?", re.S)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@domain: each @ is tried once, with the run of local characters before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans (code points) by kind as listed, then start."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if _DIGITS.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


def written(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def _shape(token: str) -> list[float]:
    digits = sum(c.isdigit() for c in token)
    core = token.strip(".,;:!?()[]{}<>\"'|*&$%#=")
    parts = core.split(".")
    letters = sum(c.isalpha() for c in core)
    return [
        float(x)
        for x in (
            "@" in token,
            "@" in token and "." in token.rpartition("@")[2],
            token.startswith("+"),
            "(" in token,
            "-" in core,
            digits == 0,
            1 <= digits <= 3,
            4 <= digits <= 6,
            7 <= digits <= 9,
            10 <= digits <= 15,
            16 <= digits <= 19,
            digits >= 20,
            letters == 0,
            letters > digits,
            len(parts) == 4 and all(p.isdecimal() and p.isascii() for p in parts),
            len(parts) == 4 and all(p.isdecimal() and p.isascii() and _octet(p) for p in parts),
            16 <= len(core) <= 19 and core.isdecimal() and core.isascii() and luhn(core),
            len(core) > 24,
        )
    ]


N_SHAPE = len(_shape(""))
LABELS = len(KINDS) + 1  # 0: none


@dataclass
class Tokens:
    """The nodes of one document: spans, features, known labels (-1 unknown), chain and skip links (node pairs)."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    known: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _pairs(x: list[tuple[int, int]]) -> np.ndarray:
    return np.array(x, dtype=np.int64).reshape(-1, 2)


def _keys(token: str) -> set[str]:
    """What makes tokens alike: the whole token, or its first part where that is long enough."""
    low = token.lower()
    whole, head = _PLAIN.sub("", low), _PLAIN.sub("", _HEAD.match(low)[0])
    return {"=" + whole, head} if len(head) >= LIKE_CHARS else {"=" + whole}


def tokens(text: str, base: list[Span]) -> Tokens | None:
    """The field's nodes: all tokens with a digit or @, and all tokens alike to one of them (a name that an address starts with)."""
    if not _SIGN.search(text):
        return None
    found = [(i, m.span(), m[0]) for i, m in enumerate(_TOKEN.finditer(text))]
    signs = [(i, span, token, _keys(token)) for i, span, token in found if _SIGN.search(token)]
    # A token without a sign has only letters in its key.
    names = {k for *_, keys in signs for k in keys if k.isalpha()}
    if names:
        plain = ((i, span, token, _keys(token)) for i, span, token in found if len(token) >= LIKE_CHARS and not _SIGN.search(token))
        signs = sorted(signs + [x for x in plain if x[3] & names])
    spans = [span for _, span, _, _ in signs]
    n = len(spans)
    chain = [(i, i + 1) for i in range(n - 1) if signs[i + 1][0] == signs[i][0] + 1]
    shape = np.array([_shape(token) for _, _, token, _ in signs])
    before, after = np.zeros_like(shape), np.zeros_like(shape)
    for i, j in chain:
        before[j], after[i] = shape[i], shape[j]
    last: dict[str, int] = {}
    skip = []
    for i, (*_, keys) in enumerate(signs):
        for key in sorted(keys):
            if key in last and last[key] != i and len(key) > 2:
                skip.append((last[key], i))
            last[key] = i
    known = np.full(n, -1)
    begin = np.array([a for a, _ in spans])
    stop = np.array([b for _, b in spans])
    for kind, a, b in base:
        known[(begin < b) & (stop > a)] = KINDS.index(kind) + 1
    features = np.concatenate((np.ones((n, 1)), shape, before, after), axis=1)
    return Tokens(spans, features, known, _pairs(chain), _pairs(sorted(set(skip))))


@dataclass
class Model:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # label x label of the next token
    skip: np.ndarray  # label x label, symmetric


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_fields(fields: list[Tokens]) -> Model:
    """Pseudo-likelihood fit: every node's label given its neighbours' labels; unknown means none, but for nodes
    linked to one with a known label: whether those carry it is what the field decides, so they teach nothing."""
    size = 1 + 3 * N_SHAPE
    empty = Model(np.zeros((size, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    if not any((f.known > 0).any() for f in fields):
        return empty
    at = np.cumsum([0] + [len(f.spans) for f in fields])
    x = np.concatenate([f.features for f in fields])
    y = np.maximum(np.concatenate([f.known for f in fields]), 0)
    chain = np.concatenate([f.chain + k for f, k in zip(fields, at, strict=False)])
    skip = np.concatenate([f.skip + k for f, k in zip(fields, at, strict=False)])
    hot = np.eye(LABELS)[y]
    teaches = np.ones((len(y), 1))
    for i, j in (skip.T, skip.T[::-1]):
        teaches[i[(y[i] == 0) & (y[j] > 0)]] = 0.0
    params = [empty.unary, empty.chain, AGREEMENT * np.eye(LABELS)]
    priors = [p.copy() for p in params]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, STEPS + 1):
        u, a, s = params
        logits = x @ u
        np.add.at(logits, chain[:, 1], a[y[chain[:, 0]]])
        np.add.at(logits, chain[:, 0], a[:, y[chain[:, 1]]].T)
        np.add.at(logits, skip[:, 0], s[y[skip[:, 1]]])
        np.add.at(logits, skip[:, 1], s[y[skip[:, 0]]])
        error = teaches * (hot - _softmax(logits)) / len(y)
        ga, gs = np.zeros_like(a), np.zeros_like(s)
        np.add.at(ga, y[chain[:, 0]], error[chain[:, 1]])
        np.add.at(ga.T, y[chain[:, 1]], error[chain[:, 0]])
        np.add.at(gs, y[skip[:, 1]], error[skip[:, 0]])
        np.add.at(gs, y[skip[:, 0]], error[skip[:, 1]])
        for p, prior, g, m, v in zip(params, priors, (x.T @ error, ga, (gs + gs.T) / 2), first, second, strict=True):
            g = g - PENALTY * (p - prior)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(*params)


def beliefs(field: Tokens, model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Marginal label probabilities by loopy belief propagation; known labels are fixed."""
    unary = _softmax(field.features @ model.unary)
    known = field.known > 0
    unary[known] = np.eye(LABELS)[field.known[known]]
    links = np.concatenate((field.chain, field.skip))
    if not len(links):
        return unary
    tables = np.exp(np.concatenate((np.broadcast_to(model.chain, (len(field.chain), LABELS, LABELS)), np.broadcast_to(model.skip, (len(field.skip), LABELS, LABELS)))))
    source = np.concatenate((links[:, 0], links[:, 1]))
    target = np.concatenate((links[:, 1], links[:, 0]))
    tables = np.concatenate((tables, tables.transpose(0, 2, 1)))
    back = np.concatenate((np.arange(len(links)) + len(links), np.arange(len(links))))
    log_unary = np.log(unary + 1e-12)
    messages = np.zeros((len(source), LABELS))  # logarithms
    for _ in range(rounds):
        total = log_unary.copy()
        np.add.at(total, target, messages)
        out = _softmax(total[source] - messages[back])
        new = np.log(np.einsum("ei,eij->ej", out, tables) + 1e-12)
        new -= np.log(np.exp(new).sum(axis=1, keepdims=True))
        change = np.abs(new - messages).max()
        messages = 0.5 * messages + 0.5 * new
        if change < 1e-3:
            break
    total = log_unary.copy()
    np.add.at(total, target, messages)
    result = _softmax(total)
    result[known] = unary[known]
    return result


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Spans of tokens outside the base spans that the field labels with confidence; only tokens alike to others can be (a
    lone token is what the patterns decide)."""
    if not model.unary.any():
        return []  # nothing was learnt
    field = tokens(text, base)
    if field is None or not len(field.skip):
        return []
    belief = beliefs(field, model)
    label = belief.argmax(axis=1)
    # Consistency needs something to be consistent with: the known labels that skip links lead to, as bits.
    reached = np.where(field.known > 0, 1 << np.maximum(field.known, 0), 0)
    for i, j in field.skip.tolist() + field.skip.tolist()[::-1]:
        reached[i] = reached[j] = reached[i] | reached[j]
    out = []
    for i in np.flatnonzero((field.known < 0) & (label > 0) & (reached >> label & 1 > 0) & (belief.max(axis=1) >= MIN_BELIEF)).tolist():
        a, b = field.spans[i]
        core = _TRIM.search(text, a, b)
        if core:
            out.append((KINDS[label[i] - 1], core.start(), core.end()))
    return out


def fit(docs: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Model:
    rows = docs.where(F.col("text").rlike("[0-9@]")).select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    below = min(_SAMPLE_PARTS, fit_documents * _SAMPLE_PARTS // max(rows.count(), 1) + 1)
    sample = rows.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id", "text"), F.lit(_SAMPLE_PARTS)) < below)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"])
        model = fit_fields([f for f in (tokens(t, base_spans(t)) for t in pdf["text"]) if f is not None])
        return pd.DataFrame({"values": [np.concatenate([p.ravel() for p in (model.unary, model.chain, model.skip)])]})

    # A repeated row is drawn with its repeats: it is learnt from once, and the bound holds for any input.
    found = sample.dropDuplicates().groupBy().applyInPandas(train, "values array<double>").collect()
    size, square = (1 + 3 * N_SHAPE) * LABELS, LABELS * LABELS
    values = np.array(found[0][0]) if found else np.zeros(size + 2 * square)
    return Model(values[:size].reshape(-1, LABELS), values[size : size + square].reshape(LABELS, LABELS), values[size + square :].reshape(LABELS, LABELS))


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows: list[list] = [[], [], [], [], [], [], []]
                for text in part.column(1).to_pylist():
                    base = base_spans(text or "")
                    more = added_spans(text or "", base, model)
                    for column, kind in zip(rows, KINDS, strict=False):
                        column.append(sum(s[0] == kind for s in base))
                    rows[4].append(hashlib.sha256(written(base).encode()).hexdigest())
                    rows[5].append(written(base + more))
                    rows[6].append(len(more))
                kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(rows, kinds, strict=True))], names=[c.split()[0] for c in FOUND.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every stretch covered by spans replaced by the kind of its first span, in angle brackets."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
        end = max(end, b)
    return "".join(out) + text[end:]


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """docs with every span in text masked; other columns as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = []
                for text in part.column(at).to_pylist():
                    base = base_spans(text or "")
                    spans = base + added_spans(text or "", base, model)
                    texts.append(masked(text, spans) if spans else text)
                yield pa.RecordBatch.from_arrays([pa.array(texts, part.schema.field(at).type) if j == at else c for j, c in enumerate(part.columns)], schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
