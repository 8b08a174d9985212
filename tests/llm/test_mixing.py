"""The mix against resharing by hand, and the cases its docstring defines."""

import re

import pytest

from riskbook.llm import mixing
from riskbook.llm.common import table
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, source string, size int, taken int, whole string"


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Deal the budget by weight; stop sources at their cap and deal the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(capped.values())
        deal = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if deal[s] > repeats * sizes[s] + 1e-9]
        if not over:
            return {**capped, **deal}
        capped.update({s: repeats * sizes[s] for s in over})


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, s, 1, 2, "x") for i, t, s in texts], SCHEMA)


@pytest.mark.parametrize("counts", [{"a": 5, "b": 50, "c": 9, "d": 700, None: 40}, {"a": 1}, {"b": 3, None: 3}, {f"s{i}": 10 + i * i for i in range(12)}])
def test_targets_match_resharing(spark, counts):
    sized = spark.createDataFrame([(s, n) for s, n in counts.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    expected = targets_by_hand(counts)
    assert got.keys() == expected.keys()
    for s in expected:
        assert got[s] == pytest.approx(expected[s], rel=1e-9)


def test_taken_words_come_near_the_targets(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = mixing.mix(docs).collect()
    texts = {r.doc_id: r for r in docs.select("doc_id", "text", "source").collect()}
    sizes, taken, target, largest = {}, {}, {}, {}
    for r in rows:
        s = texts[r.doc_id].source
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id].text or ""))
        assert r.taken in (0, r.size, 2 * r.size)
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        largest[s] = max(largest.get(s, 0), r.size)
    expected = targets_by_hand(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s], rel=1e-9)
        assert abs(target[s] - taken[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mix(docs.repartition(5)).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}


def test_smaller_budgets_are_subsets(spark):
    docs = table(spark, SF_SMALL, "documents")
    small = {r.doc_id: r.taken for r in mixing.mix(docs, share=0.3).collect()}
    large = {r.doc_id: r.taken for r in mixing.mix(docs, share=0.6).collect()}
    assert all(large[k] >= v for k, v in small.items())


def test_one_document_one_id_and_one_row_for_a_source(spark):
    """A source of one document, one of equal rows without an id, one whose rows share an id: all come near their targets."""
    texts = [(1, "w " * 100, "one")] + [(None, "a b c d e", "equal")] * 200 + [(7, f"t{i} " * (1 + i % 9), "shared") for i in range(150)] + [(i, "x y z", "rest") for i in range(100, 400)]
    docs = rows_of(spark, texts).repartition(4)
    for share in (0.3, 0.8, 1.5):
        rows = mixing.mix(docs, share=share).collect()
        plan = {}
        for r in rows:
            key = (r.source_size, r.target)
            plan[key] = plan.get(key, 0) + r.taken
        assert len(plan) == 4
        for (size, target), taken in plan.items():
            largest = {100: 100, 1000: 5}.get(size, 9)
            assert abs(target - taken) <= largest / 2 + 1e-6
        again = mixing.mix(docs.repartition(3), share=share).collect()
        assert sorted(map(str, again)) == sorted(map(str, rows))
        kept = mixing.apply_mix(docs, share=share)
        assert sum(len(r.text.split()) for r in kept.collect()) == sum(r.taken for r in rows)


def test_defined_cases(spark):
    docs = rows_of(spark, [(1, None, None), (1, None, None), (2, "", "a"), (None, "x y", "a"), (None, "x y", "a"), (3, "w " * 3000, "b"), (4, "one", None)])
    rows = mixing.mix(docs).collect()
    assert len(rows) == 7
    assert sorted((r.size, r.source_size) for r in rows) == [(0, 1), (0, 1), (0, 4), (1, 1), (2, 4), (2, 4), (3000, 3000)]
    assert mixing.mix(docs.limit(0)).count() == 0
    kept = mixing.apply_mix(docs)
    assert kept.columns == docs.columns
    by_doc = {}
    for r in rows:
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.taken
    assert sum(len((r.text or "").split()) for r in kept.collect()) == sum(by_doc.values())
