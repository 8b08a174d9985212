"""Spelling variants against brute force over all pairs of small vocabularies."""

import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from riskbook.llm import spelling
from riskbook.llm.text_arrays import U64, mix
from tests.conftest import SF_SMALL
from tests.llm.edge import edge_docs
from tests.oracle_harness import compare, duck_connect


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        around = sorted((-m, v) for v, m in counts.items() if near(w, v))
        form = around[0][1] if around and -around[0][0] >= ratio * n else None
        out[w] = [n, len(around), form, counts[form] if form else None]
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return out


def words_frame(spark, counts):
    return spark.createDataFrame([(w, n, len(w)) for w, n in counts.items()], "word string, n long, size int")


def random_counts(seed, letters="abéÿ", n=250, lengths=(6, 7, 8)):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))): rng.choice([5, 6, 30, 31, 160, 900]) for _ in range(n)}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_pairs_by_hand(spark, seed):
    counts = random_counts(seed)
    got = [(r.a, r.b) for r in spelling.near_pairs(words_frame(spark, counts)).collect()]
    assert len(got) == len({frozenset(p) for p in got})
    assert {frozenset(p) for p in got} == {frozenset((a, b)) for a in counts for b in counts if near(a, b)}


def test_small_shards_and_passes_find_the_same(spark, monkeypatch):
    counts = random_counts(5)
    whole = {frozenset((r.a, r.b)) for r in spelling.near_pairs(words_frame(spark, counts)).collect()}
    monkeypatch.setattr(spelling, "SHARD_WORDS", 8)
    monkeypatch.setattr(spelling, "PASS_BYTES", 700)
    parts = spelling.filters(words_frame(spark, counts))
    assert parts.select("pass").distinct().count() > 3 and parts.where("bits > 0").count() > 3
    assert {frozenset((r.a, r.b)) for r in spelling.near_pairs(words_frame(spark, counts)).collect()} == whole


def test_filter_has_no_false_negatives_and_few_false_positives():
    hashes = mix(np.arange(20000))
    bloom = spelling.BlockedBloom.of(hashes)
    assert len(bloom.holds(hashes)) == len(hashes)
    assert len(bloom.holds(mix(np.arange(1 << 30, (1 << 30) + 100000)))) < 1000


def test_edit_hashes_follow_from_the_word(monkeypatch):
    """Every edit that the generator names has the hash of that edit as a word, also in chunks of positions."""
    monkeypatch.setattr(spelling, "CHUNK", 40)
    words, alphabet = ["aabbab", "bbbbbb", "abcabc"], np.array([ord(c) for c in "abc"], np.uint32)
    seen = []

    def held(size, hashes):
        seen.append((size, hashes))
        return np.arange(len(hashes))

    got = list(spelling._edits(words, 6, alphabet, held, True, True))
    expected = [U64(h) for _, part in seen for h in part]
    for (_, edit), h in zip(got, expected, strict=True):
        assert spelling.word_hash(spelling.codes([edit], len(edit)))[0] == h
    assert {e for w, e in got if w == "aabbab" and len(e) == 5} == {"abbab", "aabab", "aabbb", "aabba"}


def test_variants_by_hand(spark):
    rng = random.Random(9)
    rows, counts = [], {}
    for i in range(300):
        text = " ".join(rng.choice(["Maison", "maisom", "Maisons", "kitten", "KITTEN", "kittén", "sitten", "Élanée", "élanée", "short", "x1y"]) for _ in range(60))
        rows.append((i if i % 7 else None, text, "extra", 1))
    for i, text, _, _ in rows:
        run = ""
        for c in text + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 199 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                counts[run] = counts.get(run, 0) + 1
            run = ""
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    got = {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in spelling.variants(docs).collect()}
    assert got == by_hand(counts)


def test_chains_of_forms(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625, "zzzzzz": 9}
    forms = spark.createDataFrame([(w, f) for w, f in {w: v[2] for w, v in by_hand(counts).items()}.items() if f], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == {w: "abbbbb" for w in counts if w not in ("abbbbb", "zzzzzz")}


def test_defined_cases(spark):
    docs = edge_docs(spark)
    rows = spelling.variants(docs, least_count=1).collect()
    assert rows and all(len(r.word) >= 6 for r in rows)
    assert spelling.variants(docs.limit(0)).count() == 0
    long_words = spark.createDataFrame([("q" * 30000, 9, 30000), ("q" * 29999, 50, 29999), ("q" * 15000 + "r" + "q" * 14999, 7, 30000)], "word string, n long, size int")
    assert spelling.near_pairs(long_words).count() == 2 + 1


def test_query_matches_its_sql(spark):
    name = "op11_spelling_variants"
    r = compare(spark, name, SF_SMALL, contract.queries()[name], contract.oracle_sql()[name], duck_connect(SF_SMALL))
    assert r["status"] == "match", r
