"""Signatures, verification and classes of near duplicates against exact multiset overlap."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from riskbook.llm import bagminhash as B
from riskbook.llm.common import prepare, table
from riskbook.llm.components import components
from riskbook.llm.text_arrays import buffers, shingles
from tests.llm.edge import SCHEMA, edge_docs, edge_rows


def bag(text):
    words = (text or "").split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def similarity(a, b):
    if not a and not b:
        return 1.0
    return sum((a & b).values()) / sum((a | b).values())


def test_shingles_count_like_plain_python():
    texts = ["a b c d e f a b c d e", "one two", "", None, " x\n\ty z  ", "é ü ñ 日 本 語"]
    hashes, rows = shingles(*buffers(pa.array(texts)))
    for i, t in enumerate(texts):
        assert sorted(Counter(hashes[rows == i].tolist()).values()) == sorted(bag(t).values())


def test_signatures_are_unbiased():
    """Share of equal places against the weighted Jaccard index, weights from 1 to 13."""
    rng = np.random.default_rng(7)
    places = 4096
    for _ in range(4):
        n = 40
        keys = rng.integers(0, 1 << 62, n).astype(np.uint64)
        a, b = rng.integers(0, 14, n), rng.integers(0, 14, n)
        b[: n // 2] = a[: n // 2]
        hashes, rows, weights = (np.concatenate(x) for x in ((keys[a > 0], keys[b > 0]), (np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)), (a[a > 0], b[b > 0])))
        sig = B.signatures(hashes, rows, weights, 2, places)
        exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((sig[0] == sig[1]).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / places) + 1e-9


def test_keys_do_not_depend_on_the_slice():
    rng = random.Random(11)
    texts = [" ".join(f"v{rng.randint(0, 400)}" for _ in range(rng.randint(1, 110))) for _ in range(400)]
    alone = np.concatenate([B.band_keys(pa.array([t])) for t in texts])
    for size in (2, 17, 130, 400):
        inside = np.concatenate([B.band_keys(pa.array(texts[i : i + size])) for i in range(0, len(texts), size)])
        assert (inside == alone).all()


def near_texts(rng, groups, copies, edits):
    texts = []
    for g in range(groups):
        words = [f"w{g}_{rng.randint(0, 60)}" for _ in range(rng.randint(30, 120))]
        for _ in range(copies):
            new = list(words)
            for _ in range(rng.randint(0, edits)):
                new[rng.randrange(len(new))] = f"x{rng.randint(0, 10**6)}"
            texts.append(" ".join(new))
    return texts


def classes_by_hand(rows):
    """Smallest id per class over rows (id, text) with distinct ids."""
    bags = [bag(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and similarity(bags[i], bags[j]) >= 0.8:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    smallest = {}
    for x, (i, _) in zip(label, rows, strict=True):
        smallest[x] = min(smallest.get(x, i), i)
    return {i: smallest[x] for x, (i, _) in zip(label, rows, strict=True)}


def test_verification_finds_every_part():
    texts = near_texts(random.Random(2), 4, 12, 5)
    everyone = np.ones(len(texts), dtype=bool)
    label = list(range(len(texts)))
    for i, j in B.linked(texts, everyone, everyone):
        assert similarity(bag(texts[i]), bag(texts[j])) >= 0.8
        label = [label[i] if x == label[j] else x for x in label]
    by_hand = classes_by_hand(list(enumerate(texts)))
    assert [label.index(x) for x in label] == [by_hand[i] for i in range(len(texts))]


def test_components_against_plain_search(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, 0), (500 + 1, 500)] + [(i, i + 1) for i in range(600, 640)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for e in links for x in e}
    for a, b in links:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = {k: new if v == old else v for k, v in label.items()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: min(x for x, v in label.items() if v == label[k]) for k in linked}


def test_classes_of_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("n_chars < 2500")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in B.near_duplicates(docs).collect()}
    firsts = {}
    for i, t in sorted(rows):
        firsts.setdefault(t, i)
    by_hand = classes_by_hand([(i, t) for t, i in firsts.items()])
    expected = {i: by_hand[firsts[t]] for i, t in rows}
    assert got == expected and len(set(expected.values())) < len(expected) - 20


def test_groups_in_blocks_lose_nothing(spark):
    texts = near_texts(random.Random(3), 3, 25, 6)
    rows = list(enumerate(texts))
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = B.text_classes(docs, block=4).collect()
    assert {r.copy_of: r.class_id for r in found} == {i: c for i, c in classes_by_hand(rows).items() if texts.index(texts[i]) == i}


def test_awkward_documents(spark):
    docs = edge_docs(prepare(spark))
    rows = B.near_duplicates(docs).collect()
    assert len(rows) == len(edge_rows())
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].class_id == by[11][0].class_id == 1 and not by[11][0].kept and all(r.kept for r in by[1])
    assert by[5][0].class_id == by[6][0].class_id == 5
    assert by[2][0].class_id == by[3][0].class_id  # null and empty are the same text
    assert by[7][0].class_id == 7 and by[9][0].class_id == 9
    assert len({r.class_id for r in by[None]}) == 2
    kept = B.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.class_id for r in rows})
    empty = prepare(spark).createDataFrame([], SCHEMA)
    assert B.near_duplicates(empty).count() == 0 and B.one_of_each(empty).count() == 0
