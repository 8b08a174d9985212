"""Boosted trees, their search and their explanation against brute force on small inputs."""

import itertools
import json
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskbook.functions.buckets import bucket
from riskbook.operators import boosting, explain, search
from riskbook.operators.boosting import Grower, Model, Params, Tree
from riskbook.session import scratch_path

FEATURES = ["a", "b", "c"]


def data(spark, n=160, seed=1, parts=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.choice([0.0, 1.0, 2.5, -3.0, None, 70.0]), rng.uniform(-1, 1), float(rng.randrange(4))
        y = int(rng.random() < 1 / (1 + math.exp(-(2 * b + (a or 0) / 3 - c / 2))))
        rows.append((f"id{i}", a, b if i % 17 else float("nan"), c, y, i % 3))
    rows += [("x", 1.0, 1.0, 1.0, None, 0), ("y", 1.0, 1.0, 1.0, 7, 1)]
    return spark.createDataFrame(rows, "id string, a double, b double, c double, y int, fold int").repartition(parts)


def matrix(df):
    rows = df.where("y in (0, 1)").orderBy("id").collect()
    x = np.array([[np.nan if r[f] is None else r[f] for f in FEATURES] for r in rows])
    return x, np.array([r.y for r in rows]), [r.id for r in rows]


def plain_tree(bins, y, margin, p, depth, rows):
    """The best split by trying every feature and cut, in plain sums."""
    prob = 1 / (1 + np.exp(-margin[rows]))
    g, h = np.floor((prob - y[rows]) * boosting.UNIT + 0.5) / boosting.UNIT, np.floor(prob * (1 - prob) * boosting.UNIT + 0.5) / boosting.UNIT
    score = lambda gs, hs: max(abs(gs) - p.reg_alpha, 0) ** 2 / (hs + p.reg_lambda)
    best = (p.gamma, None)
    if depth < p.max_depth:
        for f, cut in itertools.product(range(bins.shape[1]), range(65)):
            left = bins[rows, f] <= cut
            gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
            if min(hl, hr) >= p.min_child_weight and (gain := score(gl, hl) + score(gr, hr) - score(g.sum(), h.sum())) > best[0] + 1e-12:
                best = (gain, (f, cut))
    out = np.zeros(len(y))
    if best[1] is None:
        t = max(abs(g.sum()) - p.reg_alpha, 0)
        out[rows] = -math.copysign(t, g.sum()) / (h.sum() + p.reg_lambda) * p.learning_rate
        return out
    f, cut = best[1]
    for side in (bins[rows, f] <= cut, bins[rows, f] > cut):
        out += plain_tree(bins, y, margin, p, depth + 1, rows[side])
    return out


@pytest.mark.parametrize("p", [Params(n_estimators=4, max_depth=3, reg_alpha=0.2, gamma=0.1), Params(n_estimators=3, max_depth=2, learning_rate=0.7, reg_lambda=0.0, min_child_weight=2.0)])
def test_trees_equal_a_plain_split_search(spark, p):
    df = data(spark)
    model = boosting.fit(df, FEATURES, "y", "id", p)
    x, y, ids = matrix(df)
    bins, margin = boosting.to_bins(x, model.edges), np.zeros(len(y))
    for _ in range(p.n_estimators):
        margin += plain_tree(bins, y, margin, p, 0, np.arange(len(y)))
    got = {r.id: r.margin for r in boosting.predict(df, model, ["id"]).collect()}
    assert len(got) == df.count()
    np.testing.assert_allclose([got[i] for i in ids], margin, atol=1e-9)


def test_same_trees_for_any_partitions_and_after_reload(spark):
    p = Params(n_estimators=7, max_depth=3, subsample=0.7, colsample_bytree=0.6)
    tables = [boosting.fit(data(spark, parts=k), FEATURES, "y", "id", p) for k in (1, 5)]
    assert tables[0].trees == tables[1].trees
    path = tables[0].save(spark, scratch_path(spark, "model"))
    again = Model.load(spark, path)
    assert again.trees == tables[0].trees and again.params == p and [list(e) for e in again.edges] == [list(e) for e in tables[0].edges]


def test_many_files_and_models_in_one_pass(spark, monkeypatch):
    df = data(spark, 300)
    edges = boosting.bin_edges(df, FEATURES)
    monkeypatch.setattr(boosting, "TASK_ROWS", 50)
    monkeypatch.setattr(boosting, "CELLS", 200)
    table = boosting.bin_features(df, FEATURES, "y", "id", edges, "fold")
    ps = [Params(n_estimators=6, max_depth=2), Params(n_estimators=7, max_depth=4, learning_rate=0.1)]
    growers = [Grower(p, holdout=h, limit=p.n_estimators) for p in ps for h in (None, 0)]
    boosting.grow(table, growers, 3)
    monkeypatch.undo()
    for g in growers:
        alone = Grower(g.params, holdout=g.holdout, limit=g.params.n_estimators)
        boosting.grow(boosting.bin_features(df, FEATURES, "y", "id", edges, "fold"), [alone], 3)
        assert alone.trees == g.trees and alone.losses == g.losses


def test_early_stop_keeps_the_best_round(spark):
    df = data(spark, 400).withColumn("y", (F.crc32(F.col("id").cast("binary")) % 2).cast("int"))  # nothing to learn
    model = boosting.fit(df, FEATURES, "y", "id", Params(n_estimators=200, max_depth=3), F.col("fold") == 0, patience=3)
    assert len(model.trees) < 20


def test_edge_inputs(spark):
    df = data(spark)
    none = boosting.fit(df.where("y = 7"), FEATURES, "y", "id", Params(n_estimators=3))
    assert {r.probability for r in boosting.predict(df, none, ["id"]).collect()} == {0.5}
    one = boosting.fit(df.where("y = 1"), FEATURES, "y", "id", Params(n_estimators=2))
    assert all(r.probability > 0.5 for r in boosting.predict(df, one, ["id"]).collect())
    values = [None, float("nan"), float("-inf"), -8.0, -1.0, -0.5, 0.0, 1e-300, 0.5, 1.0, 1.03, 1.04, 2.0, 1e300, float("inf")]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", bucket(F.col("v")).alias("k")).orderBy("i").collect()
    assert got[0].k is None and got[1].k is None
    assert all(x.k <= y.k for x, y in zip(got[2:], got[3:], strict=False)) and len({r.k for r in got[2:]}) == 12


# ------------------------------------------------------------------ explanation


def plain_value(tree: Tree, known: dict[int, int]) -> float:
    """The mean of the tree over the cover where features outside ``known`` are unknown."""
    def walk(n):
        if tree.feature[n] < 0:
            return tree.value[n]
        l, r = tree.left[n], tree.right[n]
        if tree.feature[n] in known:
            return walk(l if known[tree.feature[n]] <= tree.bin[n] else r)
        return (tree.cover[l] * walk(l) + tree.cover[r] * walk(r)) / (tree.cover[l] + tree.cover[r])

    return walk(0)


def test_contributions_equal_all_subsets(spark):
    df = data(spark, 250)
    model = boosting.fit(df, FEATURES, "y", "id", Params(n_estimators=5, max_depth=4, min_child_weight=0.1))
    found = {r.id: r for r in explain.contributions(df, model, "id").collect()}
    x, _, ids = matrix(df)
    bins = boosting.to_bins(x, model.edges)
    for i in range(0, len(ids), 9):
        r, known = found[ids[i]], dict(enumerate(bins[i].tolist()))
        v = lambda s: sum(plain_value(t, {f: known[f] for f in s}) for t in model.trees)  # noqa: B023, E731
        assert r.base_value == pytest.approx(v(()), abs=1e-9)
        for f in range(3):
            others = [g for g in range(3) if g != f]
            phi = sum(
                math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (v((*s, f)) - v(s)) for k in range(3) for s in itertools.combinations(others, k)
            )
            assert r.contributions[f] == pytest.approx(phi, abs=1e-9)
    assert all(r.margin == pytest.approx(r.base_value + sum(r.contributions), abs=1e-9) for r in found.values())
    rows = explain.contribution_rows(explain.contributions(df, model, "id"), model, "id")
    assert {r.feature for r in rows.select("feature").distinct().collect()} <= set(FEATURES)
    assert explain.contribution_summary(explain.contributions(df, model, "id"), model, "id").count() == rows.select("feature").distinct().count()


# ------------------------------------------------------------------ search

SPACE = {"x": (-5.0, 5.0, False), "k": (1, 20, True)}


def run_proposals(seed, adaptive, n=60):
    goal = lambda p: -((p["x"] - 2.0) ** 2) - ((p["k"] - 15) / 4) ** 2
    seen = []
    for i in range(n):
        rng = random.Random(f"{seed}:{i}")
        p = search.propose(SPACE, seen, rng) if adaptive and i >= 10 else search.draw(SPACE, rng)
        assert -5 <= p["x"] <= 5 and 1 <= p["k"] <= 20 and isinstance(p["k"], int)
        seen.append((p, goal(p)))
    return seen


def test_proposals_replay_and_beat_random_draws():
    assert run_proposals(3, True) == run_proposals(3, True)
    seeds = range(12)
    tail = lambda adaptive: sum(s for seed in seeds for _, s in run_proposals(seed, adaptive)[30:])
    assert tail(True) > 0.5 * tail(False)  # both negative: the proposals' mean distance is less than half
    assert sum(max(s for _, s in run_proposals(seed, True)) for seed in seeds) > sum(max(s for _, s in run_proposals(seed, False)) for seed in seeds)


def test_parzen_density_is_one_in_the_range():
    d = search.Parzen([0.1, 0.2, 0.9], 0.0, 1.0)
    xs = np.linspace(0, 1, 4001)
    total = np.trapezoid([d.density(x) for x in xs], xs) / math.sqrt(2 * math.pi)
    assert total == pytest.approx(1.0, abs=1e-3)


def test_search_goes_on_from_its_trial_table(spark, monkeypatch):
    df = data(spark, 300)
    space = dict(search.REFERENCE_SPACE, n_estimators=(4, 9, True), max_depth=(2, 3, True))
    kw = dict(n_trials=5, folds=2, space=space, rungs=(2, 4, 8), patience=3)
    path = scratch_path(spark, "trials")
    monkeypatch.setattr(search, "STARTUP", 3)
    monkeypatch.setattr(search, "WAVE", 2)
    whole, _, _ = search.search(df, FEATURES, "y", "id", **kw, trials_path=scratch_path(spark, "trials"))
    grow, calls = boosting.grow, []

    def counted(*a, **k):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return grow(*a, **k)

    monkeypatch.setattr(boosting, "grow", counted)
    with pytest.raises(RuntimeError):
        search.search(df, FEATURES, "y", "id", **kw, trials_path=path)
    again, _, _ = search.search(df, FEATURES, "y", "id", **kw, trials_path=path)
    done = len(calls)
    key = lambda f: sorted(map(str, f.trials.collect()))
    assert key(again) == key(whole) and (again.params, again.n_trees) == (whole.params, whole.n_trees)
    third, _, _ = search.search(df, FEATURES, "y", "id", **kw, trials_path=path)
    assert len(calls) == done and key(third) == key(whole)
    rows = whole.trials.collect()
    assert {r.rung for r in rows} >= {0, 1} and len([r for r in rows if r.rung == 0]) == 5
    assert all(set(json.loads(r.params)) == set(search.REFERENCE_SPACE) for r in rows)


def test_rows_are_read_from_buffers_and_routed_as_by_a_plain_walk():
    """a slice of a binary column is one matrix over its buffer; all rows go down a tree together."""
    rng = random.Random(3)
    bins = np.array([[rng.randrange(65) for _ in range(5)] for _ in range(200)], np.uint8)
    column = boosting._binary(bins).slice(17, 120)
    read = boosting._fixed(column, np.uint8, 5)
    assert (read == bins[17:137]).all() and read.base is not None
    margins = bins.astype(np.float64) / 7
    for kind in (pa.binary(), pa.large_binary()):
        assert (boosting._fixed(boosting._binary(margins).cast(kind).slice(3), np.float64, 5) == margins[3:]).all()
    trees = [boosting.Tree(), boosting.Tree()]
    level = [0]
    for _ in range(6):
        level = [c for node in level if node % 3 != 2 for c in trees[1].split(node, rng.randrange(5), rng.randrange(16, 48), 1.0, (0.0, 0.0), (1.0, 1.0))]
    for t in trees:
        walked = []
        for row in read:
            node = 0
            while t.feature[node] >= 0:
                node = t.left[node] if row[t.feature[node]] <= t.bin[node] else t.right[node]
            walked.append(node)
        assert boosting.route(t.arrays(), read).tolist() == walked
    assert len(set(walked)) > 5 and boosting.route(trees[1].arrays(), read[:0]).tolist() == []
