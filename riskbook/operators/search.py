"""Parameter search for the boosted trees (D3): waves of proposals, successive halving, a resumable trial table.

The first wave draws its trials from the space at random; each later wave proposes from the trial table: per
parameter one Parzen density over the best trials and one over the others, and of some candidates drawn from the
first the one with the largest ratio of both. All trials of a wave and all their folds grow together (one pass over
the table per tree level, whatever the number of trials).

Every trial gets the first rung's trees; of the trials in a rung the best third goes on to the next. A fold's model stops
early when ``patience`` trees brought no lower loss on its held-out rows, and is measured by the exact AUC (D4)
of those rows at its best number of trees.

Each (wave, rung) is a folder with its trees and, written last, its rows of the trial table; a search that
is started again with the same arguments reads the folders that are whole and goes on after them. Only
parameters, trees and metrics are on the driver, never rows.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.operators import boosting
from riskbook.operators.boosting import Grower, Params
from riskbook.operators.metrics import assign_fold, roc_auc
from riskbook.session import configure, scratch_path

# The reference's search ranges as (low, high, whole numbers?).
REFERENCE_SPACE = {
    "n_estimators": (100, 1000, True),
    "max_depth": (3, 10, True),
    "learning_rate": (0.01, 0.3, False),
    "gamma": (0.5, 5.0, False),
    "subsample": (0.5, 1.0, False),
    "colsample_bytree": (0.5, 1.0, False),
    "reg_alpha": (0.0, 5.0, False),
    "reg_lambda": (0.0, 5.0, False),
}
N_TRIALS = 30
STARTUP = 10
WAVE = 10
RUNGS = (10, 30, 90, 270, 1000)
KEEP = 3
PATIENCE = 10
GOOD_SHARE = 0.25
CANDIDATES = 24

Space = dict[str, tuple[float, float, bool]]


# ------------------------------------------------------------------ proposals


def draw(space: Space, rng: random.Random) -> dict:
    return {k: rng.randint(int(lo), int(hi)) if whole else rng.uniform(lo, hi) for k, (lo, hi, whole) in space.items()}


class Parzen:
    """A mixture on [low, high]: a normal density around each observation, as wide as the gap to its neighbours, and one around the middle."""

    def __init__(self, seen: Sequence[float], low: float, high: float):
        points = sorted([(x, False) for x in seen] + [((low + high) / 2, True)])
        self.low, self.high, self.means, self.widths = low, high, [x for x, _ in points], []
        span = high - low
        for i, (x, prior) in enumerate(points):
            left = x - points[i - 1][0] if i else x - low
            right = points[i + 1][0] - x if i + 1 < len(points) else high - x
            self.widths.append(span if prior else min(span, max(left, right, span / min(100.0, 1.0 + len(points)))))

    def sample(self, rng: random.Random) -> float:
        while True:
            i = rng.randrange(len(self.means))
            x = rng.gauss(self.means[i], self.widths[i])
            if self.low <= x <= self.high:
                return x

    def density(self, x: float) -> float:
        """Each normal counts by its mass within the range."""
        total = 0.0
        for m, w in zip(self.means, self.widths, strict=True):
            mass = 0.5 * (math.erf((self.high - m) / (w * math.sqrt(2))) - math.erf((self.low - m) / (w * math.sqrt(2))))
            total += math.exp(-0.5 * ((x - m) / w) ** 2) / (w * mass)
        return total / len(self.means)


def propose(space: Space, seen: Sequence[tuple[dict, float]], rng: random.Random) -> dict:
    """Parameters of the next trial, from (parameters, score; higher is better) of those measured."""
    if not seen:
        return draw(space, rng)
    ranked = sorted(seen, key=lambda s: -s[1])
    good = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    out = {}
    for name, (low, high, whole) in space.items():
        if high <= low:
            out[name] = low
            continue
        better = Parzen([p[name] for p, _ in ranked[:good]], low, high)
        worse = Parzen([p[name] for p, _ in ranked[good:]], low, high)
        x = max((better.sample(rng) for _ in range(CANDIDATES)), key=lambda v: better.density(v) / worse.density(v))
        out[name] = int(min(high, max(low, round(x)))) if whole else x
    return out


# ------------------------------------------------------------------ trials


@dataclass
class Trial:
    number: int
    params: dict
    growers: list[Grower] = field(default_factory=list)
    auc: float | None = None
    trees: int = 0

    @property
    def stopped(self) -> bool:
        return all(g.done for g in self.growers) and all(len(g.trees) < g.limit or g.limit >= self.params["n_estimators"] for g in self.growers)

    def best_rounds(self) -> list[int]:
        return [g.best_round() for g in self.growers]


ROWS = "trial int, rung int, trees int, params string, fold_aucs array<double>, auc double, best_rounds array<int>, stopped boolean"
STATE = "trial int, fold int, losses array<double>, done boolean, trees string"


@dataclass
class Found:
    params: Params
    n_trees: int
    auc: float
    trials: DataFrame  # ROWS


def _held_out_margins(table: DataFrame, trials: Sequence[Trial], n_features: int) -> DataFrame:
    """trial, fold, label, margin of every held-out row under its fold's model, at the model's best number of trees."""
    models = [(t.number, g.holdout, [x.arrays() for x in g.trees[: g.best_round()]]) for t in trials for g in t.growers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, _, label, fold, _ in boosting._rows(batches, n_features, 0):
            for trial, holdout, trees in models:
                at = np.flatnonzero(fold == holdout)
                margin = np.zeros(len(at))
                for tree in trees:
                    margin += tree[4][boosting.route(tree, bins[at])]
                full = lambda v: pa.array(np.full(len(at), v, np.int32))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([full(trial), full(holdout), pa.array(label[at], pa.int32()), pa.array(margin)], names=["trial", "fold", "label", "margin"])

    return table.select("bins", "label", "fold", "key").mapInArrow(run, "trial int, fold int, label int, margin double")


def _measure(table: DataFrame, trials: Sequence[Trial], n_features: int) -> dict[int, list[float | None]]:
    held = _held_out_margins(table, trials, n_features)
    aucs = roc_auc(held, "margin", "label", ["trial", "fold"]).collect()  # one number per trial and fold
    out: dict[int, dict[int, float | None]] = {}
    for r in aucs:
        out.setdefault(r["trial"], {})[r["fold"]] = r["roc_auc"]
    return {t.number: [out.get(t.number, {}).get(g.holdout) for g in t.growers] for t in trials}


def _load(spark: SparkSession, path: str, trials: Sequence[Trial]) -> list[tuple] | None:
    """The rows of a rung that was measured before, with its models put back; None where the folder is not whole."""
    try:
        rows = spark.read.schema(ROWS).parquet(f"{path}/rows").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if sorted((r["trial"], r["params"]) for r in rows) != sorted((t.number, json.dumps(t.params, sort_keys=True)) for t in trials):
        raise ValueError(f"{path} holds other trials: give the search a folder of its own")
    by_number = {t.number: t for t in trials}
    for r in spark.read.parquet(f"{path}/models").collect():
        g = by_number[r["trial"]].growers[r["fold"]]
        g.trees, g.losses, g.done = [boosting.Tree(**t) for t in json.loads(r["trees"])], list(r["losses"]), r["done"]
        g.tree, g.open = None, []
    return [tuple(r) for r in rows]


def _run_rung(spark: SparkSession, path: str, table: DataFrame, trials: Sequence[Trial], rung: int, budget: int, n_features: int, patience: int) -> list[tuple]:
    for t in trials:
        for g in t.growers:
            g.limit = min(budget, t.params["n_estimators"])
    rows = _load(spark, path, trials)
    if rows is None:
        growers = [g for t in trials for g in t.growers]
        for t in trials:
            for g in t.growers:
                g.done = g.done and bool(g.losses) and len(g.losses) - 1 - g.best_round() >= patience
        boosting.grow(table, growers, n_features, patience)
        aucs = _measure(table, trials, n_features)
        rows = []
        for t in trials:
            known = [a for a in aucs[t.number] if a is not None]
            mean = sum(known) / len(known) if known else None
            rows.append((t.number, rung, max(len(g.trees) for g in t.growers), json.dumps(t.params, sort_keys=True), aucs[t.number], mean, t.best_rounds(), t.stopped))
        models = [(t.number, k, g.losses, g.done, json.dumps([asdict(x) for x in g.trees])) for t in trials for k, g in enumerate(t.growers)]
        # A folder without rows was cut off; its models may be written again.
        spark.createDataFrame(models, STATE).write.mode("overwrite").parquet(f"{path}/models")
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{path}/rows")
    by_number = {t.number: t for t in trials}
    for r in rows:
        by_number[r[0]].auc, by_number[r[0]].trees = r[5], r[2]
    return rows


def search(
    df: DataFrame, features: Sequence[str], label: str, row_key: str, n_trials: int = N_TRIALS, folds: int = 3, seed: int = 42, space: Space | None = None,
    rungs: Sequence[int] = RUNGS, patience: int = PATIENCE, trials_path: str | None = None,
) -> tuple[Found, DataFrame, list[np.ndarray]]:
    """The best parameters and number of trees, with the binned table and its edges for a refit."""
    spark = configure(df.sparkSession)
    space = space or REFERENCE_SPACE
    base = trials_path or scratch_path(spark, "trials")
    edges = boosting.bin_edges(df, features)
    folded = assign_fold(df, row_key, folds, seed, "_fold_of")
    table = boosting.bin_features(folded, features, label, row_key, edges, "_fold_of", models=n_trials * folds)
    trials: list[Trial] = []
    rows: list[tuple] = []
    while len(trials) < n_trials:
        rng = random.Random(f"{seed}:{len(trials)}")
        measured = [(t.params, t.auc) for t in trials if t.auc is not None]
        size = min(n_trials - len(trials), STARTUP if not trials else WAVE)
        wave = []
        for _ in range(size):
            params = propose(space, measured, rng) if trials else draw(space, rng)
            number = len(trials) + len(wave)
            wave.append(Trial(number, params, [Grower(Params(**params, seed=seed + number), holdout=k) for k in range(folds)]))
        rows += _run_rung(spark, f"{base}/first-{len(trials)}", table, wave, 0, rungs[0], len(features), patience)
        trials += wave
    score = lambda t: (t.auc if t.auc is not None else -1.0, -t.number)
    left = trials
    for rung, budget in enumerate(rungs[1:], 1):
        left = sorted(left, key=score, reverse=True)[: max(1, -(-len(left) // KEEP))]
        if all(t.stopped for t in left):
            break
        rows += _run_rung(spark, f"{base}/rung-{rung}", table, left, rung, budget, len(features), patience)
    best = max(left, key=score)
    n_trees = max(1, sorted(best.best_rounds())[folds // 2])
    table_rows = spark.createDataFrame(rows, ROWS)
    return Found(Params(**best.params, seed=seed + best.number), n_trees, best.auc, table_rows), table, edges
