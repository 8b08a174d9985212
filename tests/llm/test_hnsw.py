"""Graph search against brute force, with copies, ties and unusable vectors."""

import numpy as np
import pytest

from riskbook.llm import hnsw
from riskbook.llm.common import prepare, table
from pyspark.sql import functions as F


def exact(rows, is_query, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in np.flatnonzero([is_query(i) for i in ids]):
        score = x @ x[q]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in out:
        out[q].sort()
        assert [x[0] for x in out[q]] == list(range(1, len(out[q]) + 1))
    return {q: [(v, s) for _, v, s in x] for q, x in out.items()}


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_graph_recall(spread):
    """Unit vectors, and vectors of very different lengths."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 32))
    x = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= np.exp(spread * rng.normal(size=(3000, 1)))
    graph, order = hnsw.Graph.build(x, np.arange(3000))
    found = graph.search(x[:200], hnsw.EF_SEARCH)
    true = np.argsort(-(x[:200] @ x[order].T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b[:20])) / 20 for a, b in zip(true.tolist(), found.tolist(), strict=True)]) > 0.9


def test_recall_on_the_table_in_several_shards(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    vectors = [(r.vec_id, r.embedding) for r in rows.collect()]
    expected = exact(vectors, lambda i: i % 20 == 0, 20)
    usable = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    index = hnsw.build_index(usable, copies=21, shard_nodes=700)
    got = answers(hnsw.search_index(index, usable.where("vec_id % 20 = 0"), 20, block=40))
    assert got.keys() == expected.keys()
    # Blocks in one lane or in many, small blocks or large: the same answers, but for rounding in the graph search.
    lanes = answers(hnsw.search_index(index, usable.where("vec_id % 20 = 0"), 20, block=7, lane=2))
    assert lanes.keys() == got.keys()
    assert np.mean([{v for v, _ in lanes[q]} == {v for v, _ in got[q]} for q in got]) > 0.95
    recall = np.mean([len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) / 20 for q in expected])
    assert recall > 0.95
    for q, found in got.items():
        by = dict(vectors)
        assert all(s == pytest.approx(np.dot(np.array(by[v], float), np.array(by[q], float)), rel=1e-12) for v, s in found)


def test_copies_ties_and_unusable_vectors(spark):
    prepare(spark)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist(), 0) for i in range(60)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0], 1) for i in range(200)]  # a vector that most rows hold
    rows += [(100, [1.0, 0.0, 0.0, 0.0], 1)]
    bad = [(400, None, 0), (420, [0.0, -0.0, 0.0, 0.0], 0), (440, [1.0, None, 0.0, 0.0], 0), (460, [float("nan"), 1.0, 0.0, 0.0], 0), (480, [float("inf"), 1.0, 0.0, 0.0], 0), (None, [1.0, 1.0, 0.0, 0.0], 0), (500, [], 0)]
    short = [(520, [3.0, 4.0], 0), (540, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows + bad + short, "vec_id long, embedding array<double>, score int").repartition(4)
    got = answers(hnsw.nearest(df, F.col("vec_id") % 20 == 0, 20))
    expected = exact([(i, v) for i, v, _ in rows[:-1]], lambda i: i % 20 == 0, 20)
    expected |= exact([(i, v) for i, v, _ in short], lambda i: True, 20)
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in expected.items()}
    assert hnsw.nearest(df.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0
    assert hnsw.nearest(df.where("vec_id = 520"), F.col("vec_id") % 20 == 0, 20).count() == 0
