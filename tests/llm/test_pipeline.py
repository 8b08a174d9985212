"""The pipeline's stages, each on what the stage before it kept, against plain versions."""

from collections import Counter

import corpus_pipeline
from riskbook.llm import language, mixing, pii
from riskbook.llm.common import prepare, stored, table
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm.edge import edge_docs
from tests.llm.test_bagminhash import classes_by_hand


def rows(df):
    return sorted(map(tuple, df.select(*corpus_pipeline.COLUMNS).collect()), key=str)


def test_every_stage_on_the_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "near_dedup", "pii", "source_mixing", "packing"]

    first = stored(steps["language_id"](spark, docs, SF_SMALL), "t1")
    judged = language.predict(docs, language.fit(docs, F.lit(True)))
    assert rows(first) == rows(judged.where("not rejected")) and first.count() >= docs.count() - 1

    second = stored(steps["near_dedup"](spark, first, SF_SMALL), "t2")
    texts = {}
    for r in sorted(first.collect(), key=lambda r: r.doc_id):
        texts.setdefault(r.text, r.doc_id)
    by_hand = set(classes_by_hand([(i, t) for t, i in texts.items()]).values())
    assert {r.doc_id for r in second.collect()} == by_hand and second.count() == len(by_hand)
    assert set(rows(second)) <= set(rows(first))

    third = stored(steps["pii"](spark, second, SF_SMALL), "t3")
    before = {r.doc_id: r for r in second.collect()}
    changed = 0
    for r in third.collect():
        was = before.pop(r.doc_id)
        assert (r.lang, r.source, r.n_chars) == (was.lang, was.source, len(r.text))
        base = pii.base_spans(was.text)
        assert (r.text == was.text) == (not base) and not pii.base_spans(r.text)
        changed += bool(base)
    assert not before and changed

    fourth = stored(steps["source_mixing"](spark, third, SF_SMALL), "t4")
    taken = {r.doc_id: r.taken // max(r.size, 1) for r in mixing.mix(third).collect()}
    assert Counter(r.doc_id for r in fourth.collect()) == Counter({k: v for k, v in taken.items() if v})

    fifth = steps["packing"](spark, fourth, SF_SMALL).collect()
    assert Counter(r.doc_id for r in fifth if r.piece == 0) == Counter(r.doc_id for r in fourth.collect())
    by = {}
    for r in fifth:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_awkward_documents_pass_every_stage(spark):
    docs = edge_docs(prepare(spark))
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), f"edge-{name}")
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert docs.count() > 0


def test_no_documents(spark):
    docs = edge_docs(prepare(spark)).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), f"none-{name}")
        assert docs.count() == 0
