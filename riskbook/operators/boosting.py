"""Regularised boosted trees over a binned feature table, many models at a time.

The library's second-order boosting for the terms that Spark ML's trees lack: split penalty (gamma), L1 and
L2 on leaf values, row and column samples per tree, validation rows that stop a model early.

* :func:`bin_features` turns every feature into at most ``max_bins`` bins of about equal counts. A value
  falls into one of 32 buckets per power of two (exact arithmetic, so it does not depend on engine or order);
  one partially aggregated count per (feature, bucket) gives the bins, and each row keeps its bins as bytes.
* A step is one pass over that table: tasks add up gradients and Hessians per (model, node, feature, bin) of their
  rows, the sums meet per (model, node) in one shuffle, and what comes back to the driver is one best split per node.
  All models given (the trials and folds of a search) take a step in the same pass.
* Gradients are whole multiples of 2**-30, so sums are exact in any order: a retried task, other partitions or
  another engine give the same trees.
* Every ``REBASE`` trees of a model the rows' margins are written to the shared folder, so a step applies only a few trees.

Objective, split gain and leaf values are those of logistic boosting with soft-thresholded gradients:
gain = T(GL)^2/(HL+l2) + T(GR)^2/(HR+l2) - T(G)^2/(H+l2), T(G) = sign(G) max(|G|-l1, 0); a node is split
where the best gain is above gamma and both sides hold a Hessian of ``min_child_weight``; a leaf adds
-T(G)/(H+l2) x learning_rate to the margin. Trees grow level by level and are not pruned afterwards.
Equal gains go to the first feature, then the lowest bin.

Defined results: null and NaN features are their own bin below all others; rows whose label is not 0 or 1 are not
learnt from; without labelled rows a model has no tree and scores one half.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskbook.functions.buckets import bucket
from riskbook.functions.ranking import hash_hex, hash_int
from riskbook.session import configure, scratch_path

MAX_BINS = 64
UNIT = float(1 << 30)
REBASE = 10
# Rows are drawn by (a key + b) mod this prime, below a share of it.
PRIME = (1 << 31) - 1
# Tasks add up at most so many cells of one model at a time.
CELLS = 1 << 22
# Rows x models that one task of a step takes on.
TASK_ROWS = 1 << 18


@dataclass(frozen=True)
class Params:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    gamma: float = 0.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in order of creation; node 0 is the root. ``feature`` is -1 in leaves."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, gain: float, values: tuple[float, float], covers: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.gain[node] = feature, bin_, gain
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for value, cover in zip(values, covers, strict=True):
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(-1)
            self.right.append(-1)
            self.value.append(value)
            self.gain.append(0.0)
            self.cover.append(cover)
        return self.left[node], self.right[node]

    def arrays(self) -> tuple[np.ndarray, ...]:
        as_int = lambda x: np.asarray(x, np.int32)
        return as_int(self.feature), as_int(self.bin), as_int(self.left), as_int(self.right), np.asarray(self.value)


def route(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The leaf (or open node) that each row of ``bins`` comes to. Leaves lead to themselves, so all rows go down together."""
    feature, cut, left, right, _ = tree
    leaf, own = feature < 0, np.arange(len(feature))
    column, cut = np.where(leaf, 0, feature).astype(np.intp), np.where(leaf, 255, cut).astype(np.uint8)
    child = np.stack((np.where(leaf, own, left), np.where(leaf, own, right)), axis=1).astype(np.intp).ravel()
    flat, first = np.ascontiguousarray(bins).ravel(), np.arange(len(bins), dtype=np.intp) * bins.shape[1]
    node, level = np.zeros(len(bins), np.intp), np.flatnonzero(~leaf[:1])
    while len(level):
        passed = flat.take(first + column.take(node)) > cut.take(node)
        node = child.take(2 * node + passed)
        level = np.concatenate((left[level], right[level]))
        level = level[~leaf[level]]
    return node.astype(np.int32)


# ------------------------------------------------------------------ binning


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Per feature the lowest value of each of its bins, rising; bin 0 is for missing values and has none.

    A bucket with ``c`` of ``n`` rows below it is in the bin floor(c x (max_bins - 1) / n): one row
    per (feature, bucket) meets in the windows, at most ``max_bins`` numbers per feature reach the driver.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"`{f}`").cast("double").alias("v")) for i, f in enumerate(features)]))
    counted = df.select(pairs.alias("p")).select("p.*").withColumn("bucket", bucket(F.col("v"))).where(F.col("bucket").isNotNull())
    counted = counted.groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v"))
    w = Window.partitionBy("feature")
    below = F.sum("n").over(w.orderBy("bucket")) - F.col("n")
    numbered = counted.select("feature", "v", F.floor(below * (max_bins - 1) / F.sum("n").over(w)).alias("bin"))
    lowest = numbered.groupBy("feature", "bin").agg(F.min("v").alias("v")).collect()
    out: list[list[float]] = [[] for _ in features]
    for r in sorted(lowest, key=lambda r: (r["feature"], r["bin"])):
        out[r["feature"]].append(r["v"])
    return [np.asarray(x, np.float64) for x in out]


def to_bins(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins (uint8) of rows of feature values: 0 for missing, else 1 + edges passed."""
    out = np.zeros(values.shape, np.uint8)
    for i, e in enumerate(edges):
        column = values[:, i]
        # A value below all edges (not seen in training) is in the lowest bin.
        out[:, i] = np.where(np.isnan(column), 0, np.maximum(1, np.searchsorted(e, column, "right")))
    return out


def _matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    columns = [batch.column(batch.schema.get_field_index(f)).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features]
    return np.column_stack(columns) if columns else np.zeros((batch.num_rows, 0))


def bin_features(df: DataFrame, features: Sequence[str], label: str, row_key: str, edges: list[np.ndarray], fold: str | None = None, models: int = 1) -> DataFrame:
    """bins (binary, a byte a feature), label, fold, key (31 bits of the hashed id) for rows labelled 0 or 1; written
    once, dealt evenly to as many files as ``models`` models at a time call for."""
    spark = df.sparkSession
    key = hash_int(hash_hex(F.coalesce(F.col(row_key).cast("string"), F.lit(""))), 8) % PRIME
    slim = df.where(F.col(label).isin(0, 1)).select(
        *[F.col(f"`{f}`").cast("double").alias(f) for f in features], F.col(label).cast("int").alias("_label"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("_fold"), key.alias("_key")
    )

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = to_bins(_matrix(batch, features), edges)
            rest = [batch.column(batch.schema.get_field_index(c)) for c in ("_label", "_fold", "_key")]
            yield pa.RecordBatch.from_arrays([_binary(bins), *rest], names=["bins", "label", "fold", "key"])

    parts = max(1, -(-slim.count() * models // TASK_ROWS))
    path = scratch_path(spark, "binned")
    schema = "bins binary, label int, fold int, key long"
    slim.mapInArrow(binned, schema).repartition(parts).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


# ------------------------------------------------------------------ one step


@dataclass
class Grower:
    """A model while it is fitted: finished trees, the tree that grows, and what stopped it."""

    params: Params
    holdout: int | None = None  # fold whose rows validate
    trees: list[Tree] = field(default_factory=list)
    based: int = 0  # trees that the written margins already hold
    tree: Tree | None = None
    open: list[int] = field(default_factory=list)
    depth: int = 0
    columns: list[int] = field(default_factory=list)
    draw: tuple[int, int] = (1, 0)
    losses: list[float] = field(default_factory=list)  # of the validation rows before each tree
    limit: int = 0
    done: bool = False

    def begin(self, n_features: int) -> None:
        """The next tree: its columns and its draw of rows follow from seed and number."""
        rng = random.Random(self.params.seed * 1_000_003 + len(self.trees))
        n = max(1, math.ceil(self.params.colsample_bytree * n_features))
        self.columns = sorted(rng.sample(range(n_features), n)) if n < n_features else list(range(n_features))
        self.draw = (rng.randrange(1, PRIME), rng.randrange(PRIME))
        self.tree, self.open, self.depth = Tree(), [0], 0

    def best_round(self) -> int:
        """Trees at which the validation loss was lowest (all trees without validation)."""
        return int(np.argmin(self.losses)) if self.losses else len(self.trees)


def drawn(key: np.ndarray, draw: tuple[int, int], share: float) -> np.ndarray:
    return (key * draw[0] + draw[1]) % PRIME < share * PRIME


def gradients(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the logistic loss in whole units of 2**-30."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.floor((p - label) * UNIT + 0.5), np.floor(p * (1.0 - p) * UNIT + 0.5)


def _fixed(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """The values of a binary column of ``width`` numbers a row, as the rows of one matrix over its buffer."""
    _, offsets, body = column.buffers()
    start = int(np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset])
    return np.frombuffer(body, kind, len(column) * width, start).reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as a binary column."""
    raw = np.ascontiguousarray(rows)
    size = raw.shape[1] * raw.itemsize
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(np.arange(len(raw) + 1, dtype=np.int32) * np.int32(size)), pa.py_buffer(raw)])


def _rows(batches: Iterator[pa.RecordBatch], n_features: int, n_models: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        if not batch.num_rows:
            continue
        col = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: E731, B023
        bins = _fixed(col("bins"), np.uint8, n_features)
        margins = np.zeros((len(bins), n_models))
        if "margins" in batch.schema.names:
            margins = _fixed(col("margins"), np.float64, n_models).copy()
        yield bins, margins, col("label").to_numpy(), col("fold").to_numpy(), col("key").to_numpy()


def _added(grower: dict, bins: np.ndarray) -> np.ndarray:
    """What the trees since the written margins add."""
    out = np.zeros(len(bins))
    for tree in grower["trees"]:
        out += tree[4][route(tree, bins)]
    return out


def _sums(growers: list[dict], n_features: int, n_models: int, n_bins: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per (model, open node): the task's gradient and Hessian sums by feature and bin; node -1: validation loss and rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = list(_rows(batches, n_features, n_models))
        for g in growers:
            nodes, columns = g["open"], np.asarray(g["columns"], np.int64)
            width = len(columns) * n_bins
            loss = np.zeros(2)
            slot = np.full(max(nodes, default=0) + 1, -1, np.int64)
            slot[nodes] = np.arange(len(nodes))
            step = max(1, CELLS // max(1, width))
            sums = {at: np.zeros((2, min(step, len(nodes) - at) * width)) for at in range(0, len(nodes), step)}
            for bins, margins, label, fold, key in blocks:
                margin = margins[:, g["model"]] + _added(g, bins)
                learn = drawn(key, g["draw"], g["subsample"])
                if g["holdout"] is not None:
                    held = fold == g["holdout"]
                    learn &= ~held
                    if g["depth"] == 0:
                        m, y = margin[held], label[held]
                        loss += [np.floor((np.logaddexp(0, m) - m * y) * UNIT + 0.5).sum(), len(m)]
                grad, hess = gradients(margin[learn], label[learn])
                mine = bins[learn]
                where = route(g["tree"], mine)
                place = np.where(where < len(slot), slot[np.minimum(where, len(slot) - 1)], -1)
                for at, cells in sums.items():
                    inside = np.flatnonzero((place >= at) & (place < at + step))
                    if not len(inside):
                        continue
                    cell = ((place[inside] - at) * width)[:, None] + np.arange(len(columns)) * n_bins + mine[inside][:, columns]
                    for i, values in enumerate((grad[inside], hess[inside])):
                        cells[i] += np.bincount(cell.ravel(), np.repeat(values, len(columns)), cells.shape[1])
            out = []
            for at, cells in sums.items():
                for j in range(cells.shape[1] // width):
                    part = cells[:, j * width : (j + 1) * width]
                    if part[1].any():
                        out.append((g["model"], nodes[at + j], part.astype(np.int64).tobytes()))
            if loss[1]:
                out.append((g["model"], -1, loss.astype(np.int64).tobytes()))
            if out:
                yield pa.RecordBatch.from_pydict(
                    {"model": [o[0] for o in out], "node": [o[1] for o in out], "sums": [o[2] for o in out]},
                    schema=pa.schema([("model", pa.int32()), ("node", pa.int32()), ("sums", pa.binary())]),
                )

    return run


def best_split(sums: np.ndarray, p: Params | dict) -> tuple[float, int, int, float, float, float, float]:
    """gain, feature (place among the columns), bin, GL, HL, G, H of the best split of one node.

    ``sums`` is (2, features, bins) in whole units; the gain is 0 where no split is allowed.
    """
    of = p if isinstance(p, dict) else asdict(p)
    alpha, lam, least = of["reg_alpha"], of["reg_lambda"], of["min_child_weight"]

    def score(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        t = np.maximum(np.abs(g) - alpha, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h + lam > 0, t * t / (h + lam), 0.0)

    left = np.cumsum(sums, axis=2) / UNIT
    total = sums[:, 0].sum(axis=1) / UNIT
    (gl, hl), (g, h) = left, total
    gain = score(gl, hl) + score(g - gl, h - hl) - score(np.asarray(g), np.asarray(h))
    gain = np.where((hl >= least) & (h - hl >= least), gain, 0.0)
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    return float(gain[f, b]), f, b, float(gl[f, b]), float(hl[f, b]), float(g), float(h)


def leaf_value(g: float, h: float, p: Params) -> float:
    t = max(abs(g) - p.reg_alpha, 0.0)
    return (-math.copysign(t, g) / (h + p.reg_lambda) if h + p.reg_lambda > 0 else 0.0) * p.learning_rate


SPLIT = "model int, node int, gain double, feature int, bin int, gl double, hl double, g double, h double"


def _merge(params: dict[int, dict], n_bins: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in part["sums"])
        model, node = int(key[0]), int(key[1])
        if node < 0:
            row = (model, node, 0.0, -1, 0, 0.0, 0.0, total[0] / UNIT, float(total[1]))
        else:
            row = (model, node, *best_split(total.reshape(2, -1, n_bins), params[model]))
        return pd.DataFrame([row], columns=[c.split()[0] for c in SPLIT.split(", ")])

    return run


def _rebased(table: DataFrame, growers: list[dict], n_features: int, n_models: int) -> DataFrame:
    """The table with the margins of all finished trees, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, margins, label, fold, key in _rows(batches, n_features, n_models):
            for g in growers:
                margins[:, g["model"]] += _added(g, bins)
            yield pa.RecordBatch.from_arrays(
                [_binary(bins), pa.array(label, pa.int32()), pa.array(fold, pa.int32()), pa.array(key, pa.int64()), _binary(margins)],
                names=["bins", "label", "fold", "key", "margins"],
            )

    schema = "bins binary, label int, fold int, key long, margins binary"
    path = scratch_path(table.sparkSession, "margins")
    table.mapInArrow(run, schema).write.parquet(path)
    return table.sparkSession.read.schema(schema).parquet(path)


def grow(table: DataFrame, growers: list[Grower], n_features: int, patience: int | None = None, max_bins: int = MAX_BINS) -> None:
    """Grow all models to their ``limit`` of trees (or until ``patience`` trees brought no lower validation loss).

    One pass over the table per level of the models' current trees; a model whose tree is finished begins
    its next one in the same pass.
    """
    n_bins = max_bins + 1
    single = len(table.inputFiles()) == 1
    for m in growers:
        m.done = m.done or len(m.trees) >= m.limit
        m.based = 0
        if not m.done and m.tree is None:
            m.begin(n_features)
    task = lambda i, m, trees: {
        "model": i, "trees": [t.arrays() for t in trees], "tree": m.tree.arrays() if m.tree else None, "open": list(m.open), "columns": m.columns,
        "draw": m.draw, "subsample": m.params.subsample, "holdout": m.holdout, "depth": m.depth,
    }
    while any(not m.done for m in growers):
        active = [(i, m) for i, m in enumerate(growers) if not m.done]
        if any(len(m.trees) - m.based >= REBASE for _, m in active):
            table = _rebased(table, [task(i, m, m.trees[m.based :]) for i, m in active], n_features, len(growers))
            for _, m in active:
                m.based = len(m.trees)
        tasks = [task(i, m, m.trees[m.based :]) for i, m in active]
        sums = table.mapInArrow(_sums(tasks, n_features, len(growers), n_bins), "model int, node int, sums binary")
        sums = sums.coalesce(1) if single else sums  # one small file: its sums are whole already, no shuffle
        merge = _merge({i: asdict(m.params) for i, m in active}, n_bins)
        found: dict[tuple[int, int], tuple] = {(r["model"], r["node"]): r for r in sums.groupBy("model", "node").applyInPandas(merge, SPLIT).collect()}
        for i, m in active:
            _advance(m, {n: r for (j, n), r in found.items() if j == i}, n_features, patience)


def _advance(m: Grower, found: dict[int, tuple], n_features: int, patience: int | None) -> None:
    """Split the open nodes; finish the tree where none is left, and begin the next unless the model stops."""
    p = m.params
    if m.depth == 0 and m.holdout is not None and -1 in found:
        m.losses.append(found[-1]["g"] / found[-1]["h"])
        if patience is not None and len(m.losses) - 1 - m.best_round() >= patience:
            m.done, m.tree, m.open = True, None, []
            return
    opened = []
    for node in m.open:
        r = found.get(node)
        if r is None:
            continue
        if node == 0:
            m.tree.value[0], m.tree.cover[0] = leaf_value(r["g"], r["h"], p), r["h"]
        if r["gain"] > p.gamma:
            gr, hr = r["g"] - r["gl"], r["h"] - r["hl"]
            opened += m.tree.split(node, m.columns[r["feature"]], r["bin"], r["gain"], (leaf_value(r["gl"], r["hl"], p), leaf_value(gr, hr, p)), (r["hl"], hr))
    m.open, m.depth = opened, m.depth + 1
    if opened and m.depth < p.max_depth:
        return
    m.trees.append(m.tree)
    m.tree, m.open = None, []
    if len(m.trees) >= m.limit:
        m.done = True
    else:
        m.begin(n_features)


# ------------------------------------------------------------------ models


@dataclass
class Model:
    """Fitted trees with the bins they were learnt on; plain numbers, some kilobytes a tree."""

    features: list[str]
    edges: list[np.ndarray]
    trees: list[Tree]
    params: Params

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins))
        for t in self.trees:
            arrays = t.arrays()
            out += arrays[4][route(arrays, bins)]
        return out

    def threshold(self, feature: int, bin_: int) -> float:
        """Values below it (and missing ones) go left at a split of ``feature`` after ``bin_``."""
        return float(self.edges[feature][bin_]) if bin_ else -math.inf

    def table(self, spark: SparkSession) -> DataFrame:
        """tree, node, feature, bin, threshold, left, right, value, gain, cover: one row per node."""
        rows = []
        for k, t in enumerate(self.trees):
            for n in range(len(t.feature)):
                inner = t.feature[n] >= 0
                rows.append(
                    (k, n, self.features[t.feature[n]] if inner else None, t.bin[n] if inner else None, self.threshold(t.feature[n], t.bin[n]) if inner else None, t.left[n], t.right[n], t.value[n], t.gain[n], t.cover[n])
                )
        return spark.createDataFrame(rows, TREES)

    def save(self, spark: SparkSession, path: str) -> str:
        """Trees, bins and parameters as Parquet tables below ``path`` (a new folder)."""
        self.table(spark).coalesce(1).write.parquet(f"{path}/trees")
        edges = [(i, self.features[i], [float(x) for x in e]) for i, e in enumerate(self.edges)]
        spark.createDataFrame(edges, "at int, feature string, edges array<double>").coalesce(1).write.parquet(f"{path}/features")
        spark.createDataFrame([(json.dumps(asdict(self.params), sort_keys=True),)], "params string").coalesce(1).write.parquet(f"{path}/params")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        features = sorted(spark.read.parquet(f"{path}/features").collect(), key=lambda r: r["at"])
        names = [r["feature"] for r in features]
        at = {f: i for i, f in enumerate(names)}
        trees: list[Tree] = []
        for r in sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: (r["tree"], r["node"])):
            if r["node"] == 0:
                trees.append(Tree([], [], [], [], [], [], []))
            t = trees[-1]
            t.feature.append(at[r["feature"]] if r["feature"] is not None else -1)
            t.bin.append(r["bin"] or 0)
            t.left.append(r["left"])
            t.right.append(r["right"])
            t.value.append(r["value"])
            t.gain.append(r["gain"])
            t.cover.append(r["cover"])
        params = Params(**json.loads(spark.read.parquet(f"{path}/params").first()["params"]))
        return cls(names, [np.asarray(r["edges"], np.float64) for r in features], trees, params)


TREES = "tree int, node int, feature string, bin int, threshold double, left int, right int, value double, gain double, cover double"


def fit(df: DataFrame, features: Sequence[str], label: str, row_key: str, params: Params, validation: Column | None = None, patience: int | None = None, max_bins: int = MAX_BINS) -> Model:
    """One model on all rows of df. With ``validation`` (a boolean column), its rows do not train; the model keeps the
    trees up to its lowest loss there and stops after ``patience`` trees without a lower one."""
    configure(df.sparkSession)
    if validation is not None:
        df = df.withColumn("_fold", validation.cast("int"))
    edges = bin_edges(df, features, max_bins)
    table = bin_features(df, features, label, row_key, edges, "_fold" if validation is not None else None)
    m = Grower(params, holdout=1 if validation is not None else None, limit=params.n_estimators)
    grow(table, [m], len(features), patience, max_bins)
    return Model(list(features), edges, m.trees[: m.best_round()] if m.losses else m.trees, params)


def predict(df: DataFrame, model: Model, keep: Sequence[str]) -> DataFrame:
    """The kept columns with ``margin`` and ``probability`` of every row, in one pass without a shuffle."""
    sent = configure(df.sparkSession).sparkContext.broadcast(model)  # trees only: bounded by trees x 2**depth
    features = model.features
    slim = df.select(*keep, *[F.col(f"`{f}`").cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    schema = df.select(*keep).schema.add("margin", "double").add("probability", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            margin = m.margins(to_bins(_matrix(batch, [f"_x{i}" for i in range(len(features))]), m.edges))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(margin), pa.array(1.0 / (1.0 + np.exp(-margin)))], names=[*keep, "margin", "probability"])

    return slim.mapInArrow(run, schema)


def gain_by_feature(trees: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, n_splits, total_gain, importance (share of all gain) from a table of trees; unused features with 0."""
    spark = trees.sparkSession
    used = trees.where(F.col("feature").isNotNull()).groupBy(F.col("feature").alias("_f")).agg(F.count(F.lit(1)).alias("n"), F.sum("gain").alias("g"))
    every = spark.createDataFrame([(f,) for f in features], "feature string").join(used, F.col("feature") == F.col("_f"), "left")
    total = F.sum("g").over(Window.partitionBy())  # one row per feature
    return every.select(
        "feature", F.coalesce("n", F.lit(0)).cast("long").alias("n_splits"), F.coalesce("g", F.lit(0.0)).alias("total_gain"), F.coalesce(F.col("g") / total, F.lit(0.0)).alias("importance")
    )
