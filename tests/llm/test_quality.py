"""Certified quality rules: measures by brute force, the tail against exact fractions, the guarantee on planted labels."""

import random
import re
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from riskbook.llm import quality
from riskbook.llm.common import held_out
from tests.conftest import SF_MID
from tests.llm.edge import edge_docs
from tests.oracle_harness import compare, duck_connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated), "n_lines": len(lines),
    }


def texts():
    rng = random.Random(3)
    out = ["", " ", "\n\n", "\x0b\x0c", "a", "a b c d e", "a a a a a a", "a b c d e a b c d e", "x\n\nx\n x\nx", "## ** é ü \U0001f600|<>", "a b c d e f " * 700]
    for _ in range(120):
        out.append("".join(rng.choice("ab#  \n\t") for _ in range(rng.randrange(120))))
    return out


def test_measures_by_hand(spark):
    rows = [(i, t, "en") for i, t in enumerate(texts())] + [(900, None, None)]
    got = quality.measures(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("lang")).collect()
    assert len(got) == len(rows)
    by_id = {i: t for i, t, _ in rows}
    for r in got:
        assert {k: r[k] for k in measured_by_hand("")} == measured_by_hand(by_id[r.doc_id])


@pytest.mark.parametrize("p", [0.01, 0.2])
def test_tail_is_exact(spark, p):
    cases = [(k, n) for n in (1, 2, 15, 16, 40, 400, 1500) for k in {0, 1, 2, 7, int(n * p) - 1, int(n * p)} if 0 <= k <= n]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect():
        q = Fraction(p)
        exact = sum(comb(r.n, i) * q**i * (1 - q) ** (r.n - i) for i in range(r.k + 1))
        assert r.t == (1.0 if r.k >= r.n * p else pytest.approx(float(exact), rel=1e-9))


def labelled(spark, n=6000, seed=1):
    """Two strata; low-quality texts carry many symbols, good ones hardly any; one rule cannot be told from chance."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        share = rng.uniform(0.2, 0.6) if bad else rng.choice([0, 0, 0, rng.uniform(0, 0.08)])
        words = [("##" if rng.random() < share else "".join(rng.choice("abcde") for _ in range(5))) for _ in range(40)]
        docs.append((i, " ".join(words), "s1" if i % 3 else "s2"))
        labels.append((i, int(not bad)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_false_rejections_stay_below_the_limit(spark):
    docs, labels = labelled(spark)
    half = held_out("doc_id", 2, 1)
    m = quality.measures(docs, F.col("lang"))
    cut = {(r.stratum, r.rule): r for r in quality.certified(m, labels, half).collect()}
    assert ("s1", "symbols") in cut
    level = quality.RISK / len(quality.RULES) / 2
    assert all(r.p_value <= level for r in cut.values())
    judged = quality.judge(docs, labels, F.col("lang"), half).join(labels, "doc_id").collect()
    good, bad = [r for r in judged if r.quality == 1], [r for r in judged if r.quality == 0]
    assert sum(not r.kept for r in good) <= quality.LIMIT * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_few_labels_certify_nothing(spark):
    docs, labels = labelled(spark, n=200)
    judged = quality.judge(docs, labels, F.col("lang"), held_out("doc_id", 2, 1))
    assert judged.where("kept <> (not base_failed)").count() == 0


def test_shuffled_labels_reject_at_most_the_limit(spark):
    docs, labels = labelled(spark, n=3000)
    noise = labels.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 > 0).cast("int").alias("quality"))
    judged = quality.judge(docs, noise, F.col("lang"), held_out("doc_id", 2, 1)).join(noise, "doc_id").where("quality = 1 and not base_failed").collect()
    assert sum(not r.kept for r in judged) <= quality.LIMIT * len(judged)


def test_defined_cases(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 1), (None, 0), (9, None), (10, 7)], "doc_id long, quality int")
    rows = quality.judge(docs, labels, F.col("lang"), held_out("doc_id", 2, 1)).collect()
    assert len(rows) == docs.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 10)
    assert quality.judge(docs.limit(0), labels, F.col("lang"), held_out("doc_id", 2, 1)).count() == 0
    assert quality.judge(docs, labels.limit(0), F.col("lang"), held_out("doc_id", 2, 1)).where("kept <> (not base_failed)").count() == 0


def test_query_matches_its_sql(spark):
    name = "op13_certified_quality"
    r = compare(spark, name, SF_MID, contract.queries()[name], contract.oracle_sql()[name], duck_connect(SF_MID))
    assert r["status"] == "match", r
