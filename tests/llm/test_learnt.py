"""Language identification, toxicity and personal data: held-out accuracy, planted cases, awkward input."""

import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskbook.llm import language, pii, queries, toxicity
from riskbook.llm.common import held_out, prepare, table
from tests.llm.edge import SCHEMA, edge_docs, edge_rows

SF = "/root/testdata/sf0.01"


def test_held_out_is_crc32_of_the_id_as_text(spark):
    import zlib

    rows = spark.range(300).select("id", held_out("id", 3, 1).alias("a"), held_out("id", 4, 2).alias("b")).collect()
    assert all(r.a == (zlib.crc32(str(r.id).encode()) % 3 == 1) and r.b == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


# ------------------------------------------------------------------ language


def test_ngram_counts_by_hand():
    counts = language.ngram_counts(pa.array(["Ab, c", "", None, "12", "ab  C!"]))
    assert counts.sum(axis=1).tolist()[1:4] == [0, 0, 0]
    assert (counts[0][counts[0] > 0].sum(), counts[0].sum()) == (8, 8)  # pairs and triples of "ab c"
    assert counts[4].sum() == 10 and np.minimum(counts[0], counts[4]).sum() == 8  # one blank more, at the end


def test_language_of_held_out_documents(spark):
    rows = queries.op6_language_id(spark, SF)
    truth = table(spark, SF, "documents").select("doc_id", "lang")
    seen = rows.join(truth, "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in seen]) > 0.99
    assert sum(r.rejected for r in seen) <= 1 and all(0 <= r.score <= 1 for r in seen)


@pytest.mark.parametrize("unknown", ["fr", "de"])
def test_an_unlearnt_language_is_rejected(spark, unknown):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    out = held_out("doc_id", 3, 1)
    model = language.fit(docs, ~out & (F.col("lang") != unknown))
    rows = language.predict(docs.where(out), model).groupBy((F.col("lang") == unknown).alias("strange")).agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()
    share = {r.strange: r.share for r in rows}
    assert share[True] > 0.9 and share[False] < 0.01


def test_odd_rows_do_not_set_the_floor():
    seen = [("x", False, 900, 5000), ("x", False, 1, 2), ("y", True, 300, 10)]
    floors = language.floors_of(["x", "x", "y"], seen)
    assert floors[0].tolist() == floors[1].tolist() and floors[0][0] == pytest.approx(0.9 * language.FLOOR_MARGIN)
    assert 0 < floors[0][1] < floors[0][0] and floors[2][1] == pytest.approx(0.3 * language.FLOOR_MARGIN)


def test_language_of_awkward_documents(spark):
    model = language.fit(table(spark, SF, "documents"), F.lit(True))
    docs = edge_docs(prepare(spark))
    rows = language.predict(docs, model)
    assert rows.columns == [*(c for c in docs.columns if c != "score"), "lang_pred", "score", "rejected"]
    rows = rows.collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        letters = bool(r.text) and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters) and (letters or (r.score == 0 and r.rejected))
    strange = spark.createDataFrame([(1, "日本語の文章です"), (2, "ййй ззз ххх ъъъ")], "doc_id long, text string")
    assert all(r.rejected and r.lang_pred != "und" for r in language.predict(strange, model).collect())
    empty = spark.createDataFrame([], SCHEMA)
    none = language.fit(empty, F.lit(True))
    assert language.predict(empty, model).count() == 0
    assert {(r.lang_pred, r.score) for r in language.predict(docs, none).collect()} == {("und", 0.0)}


# ------------------------------------------------------------------ toxicity


def documents_with(rng, n, bad):
    """n documents of common words; one in four has a bad word in one sentence, which is its label."""
    texts, labels, where = [], [], []
    for _ in range(n):
        sentences = [" ".join(f"w{chr(97 + rng.randint(0, 25))}{chr(97 + rng.randint(0, 25))}" for _ in range(8)) for _ in range(rng.randint(1, 9))]
        toxic = rng.random() < 0.25
        k = rng.randrange(len(sentences))
        if toxic:
            sentences[k] += f" {rng.choice(bad)}"
        texts.append(". ".join(sentences))
        labels.append(int(toxic))
        where.append(k)
    return texts, np.array(labels), where


def test_noisy_or_finds_the_sentence():
    rng = random.Random(4)
    texts, labels, _ = documents_with(rng, 800, ["vile", "rotten", "foul"])
    model = toxicity.fit_texts(pd.Series(texts), labels, chunk=100)
    texts, labels, where = documents_with(rng, 300, ["VILE", "rotten", "rottenest"])
    score, rows, number, p = model.score(pa.array(texts))
    assert ((score >= 0.3) == labels).mean() > 0.97
    for i in np.flatnonzero(labels):
        here = rows == i
        assert number[here][p[here].argmax()] == where[i]
    # The document's score is the noisy-or of its sentences'.
    alone = [1 - np.prod([1 - model.score(pa.array([s]))[0][0] for s in t.split(". ")]) for t in texts[:20]]
    assert score[:20] == pytest.approx(alone, abs=1e-9)


def test_spans_of_sentences():
    text = "Fine. Élan is rotten!\n\n  last one "
    assert [text[a:b] for a, b in toxicity.spans_of(text, [0, 1, 2, 4])] == ["Fine", "Élan is rotten", "", "last one"]


def test_toxicity_of_held_out_documents(spark):
    rows = queries.op3_toxicity_mil(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen = rows.join(labels, "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in seen if r.toxic == 1]
    clean = [r.predicted for r in seen if r.toxic == 0]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.02


def test_toxicity_of_awkward_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(docs, labels, F.lit(True))
    rows = toxicity.score(edge_docs(spark), model).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[2].score == by[3].score == by[4].score == 0 and by[5].score == by[6].score
    text = edge_rows()[7][1]
    assert "idiot" in " ".join(text[s.start : s.end] for s in by[5].offending)
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity.score(empty, model).count() == 0
    odd = spark.createDataFrame([(1, 7), (None, 1), (2, None)], "doc_id long, toxic int")
    assert all(r.score == 0 for r in toxicity.score(edge_docs(spark), toxicity.fit(docs, odd, F.lit(True))).collect())


def plain_sentences(text):
    """Features of each sentence with a word: words and their beginnings, the beginnings marked by their length."""
    out = []
    for sentence in re.split(r"[\n.!?]", text.lower()):
        found = re.findall(rb"[a-z\x80-\xff]+", sentence.encode())
        if found:
            out.append([(k, w[:k] if k else w) for w in found for k in (0, *toxicity.PREFIXES)])
    return out


def test_scores_and_chosen_words_equal_a_plain_version(spark):
    texts = [r.text for r in table(spark, SF, "documents").orderBy("doc_id").collect()][:400] + ["", "é à. Straße! x", "..\n?", "word"]
    labels = np.array([int("idiot" in t or i % 50 == 0) for i, t in enumerate(texts)])
    hashes, rows, _ = toxicity.sentences(pa.array(texts))
    assert [len(x) for x in np.split(rows, np.searchsorted(rows, range(1, len(texts))))] == [sum(map(len, plain_sentences(t))) for t in texts]
    # The features come in text order, so each one's hash is known.
    names = dict(zip((f for t in texts for s in plain_sentences(t) for f in s), hashes.tolist(), strict=True))
    assert len(set(names.values())) == len(names)
    holds = [{f for s in plain_sentences(t) for f in s} for t in texts]
    n, positive, expected = len(texts), int(labels.sum()), set()
    for f, h in names.items():
        have = [f in x for x in holds]
        rate, toxic = sum(have) / n, sum(label for label, x in zip(labels, have, strict=True) if x)
        deviation = np.sqrt(positive * rate * (1 - rate) * (1 - positive / n))
        if sum(have) >= toxicity.MIN_DOCUMENTS and abs(toxic - positive * rate) >= toxicity.MIN_Z * max(deviation, 10**-4.5):
            expected.add(h)
    model = toxicity.fit_texts(pd.Series(texts), labels, chunk=37)
    assert expected and model.words.tolist() == sorted(expected)
    weight = dict(zip(model.words.tolist(), model.weights, strict=True))
    scores = model.score(pa.array(texts))[0]
    for text, score in zip(texts, scores, strict=True):
        none = 1.0
        for s in plain_sentences(text):
            none *= 1 - 1 / (1 + np.exp(-(model.bias + sum(weight.get(names[f], 0.0) for f in s))))
        assert score == pytest.approx(1 - none, abs=1e-9)


def test_a_repeated_id_is_learnt_from_once(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    labels = table(spark, SF, "labels").select("doc_id", "toxic")
    hot = spark.range(3000).select(F.lit(7_000_000).cast("long").alias("doc_id"), F.concat(F.lit("so many idiots wrote text "), F.col("id")).alias("text"))
    row = spark.createDataFrame([(7_000_000, 0)], "doc_id long, toxic int").select("doc_id", F.col("toxic").cast(labels.schema["toxic"].dataType))
    plain = toxicity.fit(docs, labels, F.lit(True))
    once = hot.orderBy(F.xxhash64("text")).limit(1)
    more = toxicity.fit(docs.unionByName(hot), labels.unionByName(row), F.lit(True))
    one = toxicity.fit(docs.unionByName(once), labels.unionByName(row), F.lit(True))
    assert more.words.tolist() == one.words.tolist() and more.weights.tolist() == one.weights.tolist()
    assert len(set(more.words.tolist()) ^ set(plain.words.tolist())) <= 0.05 * len(plain.words)


# ------------------------------------------------------------------ personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(9)
    bits = ["a", "b.c", "@", "x@y.z", ".", "-", " ", "1", "22", "255", "256", "3.4.5.6", "4387513035237269", "4387 5130 3523 7269", "+1 (988) 555-2485", "+", "(", ")", "é", "٣", "\n", "0003.4.5.6", "%"]
    for _ in range(20000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_patterns_stay_linear():
    for unit in ("a", "1", "1.", "a@", "+1", "1 ", "a.b@c", "+1(", "-"):
        assert isinstance(pii.base_spans(unit * 60_000), list)


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(table(spark, "/root/testdata/sf0.1", "documents"))


def test_alike_tokens_share_a_label(field):
    text = "call +1 (988) 555-2485 now. Again: (988) 555-2485, not in 1999 and (1999). Room 42, room 42."
    base = pii.base_spans(text)
    more = pii.added_spans(text, base, field)
    assert [text[a:b] for _, a, b in base] == ["+1 (988) 555-2485"]
    assert [(k, text[a:b]) for k, a, b in more] == [("phone", "988"), ("phone", "555-2485")]
    assert pii.masked(text, base + more).startswith("call <phone> now. Again: (<phone>) <phone>, not in 1999")
    # Without the first mention there is nothing to be consistent with.
    assert pii.added_spans(text[23:], pii.base_spans(text[23:]), field) == []


def test_belief_propagation_is_exact_on_a_chain(field):
    text = "+1 22 x 1.2.3.4 55 66 7777"
    nodes = pii.tokens(text, [])
    nodes.skip = nodes.skip[:0]
    got = pii.beliefs(nodes, field, rounds=60)
    import itertools

    unary = np.exp(nodes.features @ field.unary)
    total = np.zeros_like(unary)
    for labels in itertools.product(range(pii.LABELS), repeat=len(unary)):
        weight = np.prod([unary[i, y] for i, y in enumerate(labels)]) * np.prod([np.exp(field.chain[labels[i], labels[j]]) for i, j in nodes.chain])
        for i, y in enumerate(labels):
            total[i, y] += weight
    assert got == pytest.approx(total / total.sum(axis=1, keepdims=True), abs=2e-3)


def exact_marginals(nodes, field):
    """Label probabilities by adding up all labellings; known labels are fixed."""
    import itertools

    unary = np.exp(nodes.features @ field.unary)
    options = [[k] if k > 0 else range(pii.LABELS) for k in nodes.known.tolist()]
    total = np.zeros_like(unary)
    for labels in itertools.product(*options):
        weight = np.prod([unary[i, y] for i, y in enumerate(labels)])
        for links, table_ in ((nodes.chain, field.chain), (nodes.skip, field.skip)):
            weight *= np.prod([np.exp(table_[labels[i], labels[j]]) for i, j in links])
        for i, y in enumerate(labels):
            total[i, y] += weight
    return total / total.sum(axis=1, keepdims=True)


def test_belief_propagation_with_skip_links_and_loops(field):
    texts = ["mail ana.silva@x.org or ana.silva 77 x 77 88", "+1 (988) 555-2485 then 555-2485 and 555-2485 988", "1.2.3.4 a 1.2.3.4, 1.2.3.4 9"]
    for text in texts:
        nodes = pii.tokens(text, pii.base_spans(text))
        assert len(nodes.skip)
        got, exact = pii.beliefs(nodes, field, rounds=80), exact_marginals(nodes, field)
        assert (got.argmax(axis=1) == exact.argmax(axis=1)).all()
        assert np.abs(got - exact).max() < 0.15


def planted(rng, n=400):
    """Texts with one pattern span and repeats of it that no pattern finds; numbers and words that are nobody's."""
    names = ["maria.souza", "john_fletcher", "annelise.weber", "p.dubois77", "kowalska"]
    out = []
    for _ in range(n):
        words = [rng.choice(["the", "room", "42", "1999", "costs", "order", "was", "7.5", "on", "monday", "twice"]) for _ in range(rng.randrange(20, 60))]
        name, number = rng.choice(names), f"{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
        kind = rng.choice(["email", "phone"])
        first, again = (f"{name}@mail{rng.randrange(9)}.org", rng.choice([name, f"{name}[at]mail.org", f"{name},"])) if kind == "email" else (f"+1 (555) {number}", number)
        at = rng.randrange(5, 10)
        words.insert(at, first)
        words.insert(rng.randrange(at + 4, len(words) + 1), again)
        out.append((kind, again, " ".join(words)))
    return out


def test_added_spans_have_precision_and_recall_on_planted_repeats(field):
    hits = added = 0
    rows = planted(random.Random(5))
    for kind, again, text in rows:
        more = pii.added_spans(text, pii.base_spans(text), field)
        where = text.rindex(again)
        hits += any(k == kind and a < where + len(again) and b > where for k, a, b in more)
        added += len(more)
    print("planted", len(rows), "found", hits, "added", added)
    assert hits >= 0.8 * len(rows) and hits >= 0.9 * added


def test_texts_without_personal_data_get_no_span(field):
    rng = random.Random(6)
    for _ in range(300):
        text = " ".join(rng.choice(["the", "room", "42", "1999", "1999", "costs", "7.5", "12:30", "2024-01-05", "order", "B52", "monday"]) for _ in range(50))
        base = pii.base_spans(text)  # digits may happen to pass the card test
        more = pii.added_spans(text, base, field)
        assert {k for k, *_ in more} <= {k for k, *_ in base}


def test_personal_data_of_awkward_documents(spark, field):
    rows = pii.find(edge_docs(prepare(spark)), field).collect()
    texts = {r[0]: r[1] or "" for r in edge_rows() if r[0] is not None}
    assert len(rows) == len(edge_rows())
    import hashlib

    for r in rows:
        if r.doc_id is not None:
            base = plain_spans(texts[r.doc_id])
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
            assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
            assert set(r.spans.split(",")) >= {f"{k}:{a}:{b}" for k, a, b in base}
    docs = edge_docs(spark)
    clean = pii.redact(docs, field)
    assert clean.columns == docs.columns
    by = {r.doc_id: r for r in clean.collect()}
    assert by[10].text == "<|endoftext|> mail <email> now" and by[5].text.endswith("Ring <phone>.") and by[2].text is None
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.find(empty, pii.fit(empty)).count() == 0
