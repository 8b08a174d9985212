"""Sketches against exact shingle sets; edited texts against plain Python."""

import hashlib

import pyarrow as pa
import pytest

from riskbook.llm import sketches as S
from riskbook.llm.common import prepare, table
from tests.conftest import SF_SMALL
from tests.llm.edge import SCHEMA, edge_docs, edge_rows


def shingle_set(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return 1.0 if a == b else len(a & b) / len(a | b)


def edits(spark, rows):
    """rows (doc_id, text) in descending id, null last, then hash and text; each text with its edited text and the next one."""
    hashes = {r.text: r.hash for r in spark.createDataFrame([(t or "",) for _, t in rows], "text string").selectExpr("text", "xxhash64(text) AS hash").collect()}
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1] or ""], r[1] or ""))
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        yield i, t, t[: len(t) - len(t) // 2] + after[: len(t) // 2], after


def test_estimates_follow_the_exact_values():
    base = [f"w{i}" for i in range(6000)]
    for other in (base[:3000] + [f"x{i}" for i in range(3000)], base[500:900], base):
        a, b = S.sketches(pa.array([" ".join(base), " ".join(other)]))
        assert abs(S.likeness(a, b) - jaccard(" ".join(base), " ".join(other))) < 0.06
        assert abs(S.containment(b, a) - len(shingle_set(" ".join(other)) & shingle_set(" ".join(base))) / len(shingle_set(" ".join(other)))) < 0.08
        assert S.Sketch.parse(a.text()).text() == a.text()
        both = S.sketches(pa.array([" ".join(base) + "\n" + " ".join(other)]))[0]
        merged = S.merge(a, b)
        assert set(merged.hashes.tolist()) <= set(both.hashes.tolist()) | set(a.hashes.tolist()) | set(b.hashes.tolist())


def test_short_texts_are_exact():
    texts = ["a b c d e f g", "a b c d e f h", "a b", "", None, "a b c d e f g"]
    found = S.sketches(pa.array(texts))
    for x, a in zip(texts, found, strict=True):
        for y, b in zip(texts, found, strict=True):
            assert S.likeness(a, b) == pytest.approx(jaccard(x, y))
    assert found[0].text() == found[5].text() and found[3].text() == "1:"


def test_repetitive_texts_are_exact():
    texts = [f"{word} " * n for word in ("ha", "ho", "hum") for n in (5, 70, 900)]
    texts += [" ".join([f"line {k} says the same thing again"] * 40) for k in range(20)]
    found = S.sketches(pa.array(texts))
    assert all(len(a.hashes) == len(shingle_set(t)) for t, a in zip(texts, found, strict=True))
    for x, a in zip(texts, found, strict=True):
        for y, b in zip(texts, found, strict=True):
            assert S.likeness(a, b) == pytest.approx(jaccard(x, y))


def test_a_short_text_against_a_long_one():
    long = S.sketches(pa.array([" ".join(f"w{i}" for i in range(6000))]))[0]
    short = S.sketches(pa.array([f"x{i} y z" for i in range(60)] + [""]))
    got = [S.containment(a, long) for a in short]
    # Nothing of a short text below the long one's fraction says nothing; a text without words is in every text.
    assert got[-1] == 1.0 and None in got and set(got[:-1]) <= {None, 0.0}
    assert all(S.likeness(a, long) == 0 for a in short)
    # An empty sample is not known to equal another one, and no text's own sketch is one.
    assert S.likeness(S.Sketch.parse("8:"), S.Sketch.parse("8:")) == 0 and S.containment(S.Sketch.parse("8:"), long) is None
    assert all(len(a.hashes) for k in range(200) for a in S.sketches(pa.array([" ".join(f"t{k}_{i}" for i in range(14))]), full=0))


@pytest.mark.parametrize("partitions", [1, 7])
def test_edited_texts_of_the_table(spark, partitions):
    prepare(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        docs = table(spark, SF_SMALL, "documents")
        got = {r.doc_id: r for r in S.edited_likeness(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(got) == len(rows)
    error = 0.0
    for i, text, edited, after in edits(spark, rows):
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        error += abs(r.near_edited - jaccard(text, edited)) / len(rows)
        assert abs(r.near_next - jaccard(text, after)) < 0.3
    # A text of some 300 shingles keeps about 40: a standard error of 0.06 and a mean one of 0.05.
    assert error < 0.07
    alone = {r.doc_id: r.fingerprint for r in S.fingerprints(docs).collect()}
    assert alone == {i: r.fingerprint for i, r in got.items()}


def test_awkward_documents(spark):
    got = S.edited_likeness(edge_docs(prepare(spark))).collect()
    expected = sorted((i is None, i or 0, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in edits(spark, [r[:2] for r in edge_rows()]))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in got) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert S.edited_likeness(prepare(spark).createDataFrame([], SCHEMA)).count() == 0
    one = S.edited_likeness(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1.0


def test_an_id_and_no_id_that_hold_a_third_of_the_rows_each(spark):
    prepare(spark)
    rows = [(i, f"text {i}") for i in range(300)] + [(150, f"hot {i}") for i in range(300)] + [(None, f"none {i % 40}") for i in range(300)]
    rows += [(151, "the same again and again")] * 300  # equal rows, cut by any number
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        sizes = {r.bucket: r["count"] for r in S.in_id_ranges(docs).groupBy("bucket").count().collect()}
        got = S.edited_likeness(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sizes) >= 15 and max(sizes.values()) <= 3 * len(rows) / 20
    expected = sorted((i is None, i or 0, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in edits(spark, rows))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in got) == expected
