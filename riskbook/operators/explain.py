"""Contributions of features to every customer's score.

The margin of a row is split exactly: base value (the mean margin over the training cover) plus one contribution per
feature, the Shapley value of the game in which unknown features follow both sides of a split in
proportion to the training cover. Each leaf is a product over the features on its path, so its
part depends only on which of them the row satisfies: a task works out the few patterns that occur among its rows, not
every row, and adds them up leaf by leaf. One pass over the table, no shuffle; trees are sent to the tasks.

Defined results: missing features go the way they do in scoring; features no tree uses contribute 0; a model without trees
has base value 0 and no contributions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from riskbook.operators.boosting import Model, Tree, _matrix, to_bins
from riskbook.session import configure


def leaves(tree: Tree) -> Iterator[tuple[float, list[tuple[int, int, int, float]]]]:
    """value and path of every leaf; a path has, per feature, (feature, above, up to, share): the row satisfies it if its bin
    is above the one and at most the other, and ``share`` is the part of the cover that does along the path."""
    todo: list[tuple[int, dict[int, tuple[int, int, float]]]] = [(0, {})]
    while todo:
        node, path = todo.pop()
        f = tree.feature[node]
        if f < 0:
            yield tree.value[node], [(k, *v) for k, v in path.items()]
            continue
        above, upto, share = path.get(f, (-1, 255, 1.0))
        whole = tree.cover[tree.left[node]] + tree.cover[tree.right[node]]
        for child, lo, hi in ((tree.left[node], above, min(upto, tree.bin[node])), (tree.right[node], max(above, tree.bin[node]), upto)):
            part = tree.cover[child] / whole if whole else 0.5
            todo.append((child, {**path, f: (lo, hi, share * part)}))


def base_value(trees: Sequence[Tree]) -> float:
    total = 0.0
    for t in trees:
        for value, path in leaves(t):
            p = value
            for *_, share in path:
                p *= share
            total += p
    return total


def pattern_parts(shares: np.ndarray, met: np.ndarray) -> np.ndarray:
    """Shapley value of each feature of a leaf of value 1, for each pattern (row of ``met``) of features satisfied.

    Without feature i, the coalitions of size k of the others are worth the k-th coefficient of
    prod(share + met x); they weigh k! (d-1-k)! / d!, and feature i changes the product by met - share.
    """
    patterns, d = met.shape
    weights = np.array([factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)])
    out = np.zeros((patterns, d))
    for i in range(d):
        poly = np.zeros((patterns, d))
        poly[:, 0] = 1.0
        for j in range(d):
            if j != i:
                poly[:, 1:] = poly[:, 1:] * shares[j] + poly[:, :-1] * met[:, j : j + 1]
                poly[:, 0] *= shares[j]
        out[:, i] = (met[:, i] - shares[i]) * (poly @ weights)
    return out


def tree_contributions(tree: Tree, bins: np.ndarray, out: np.ndarray) -> None:
    """Add the contributions of one tree to ``out`` (rows x features)."""
    for value, path in leaves(tree):
        if not path or value == 0.0:
            continue
        features = [p[0] for p in path]
        met = np.column_stack([(bins[:, f] > lo) & (bins[:, f] <= hi) for f, lo, hi, _ in path])
        code = met @ (1 << np.arange(len(path), dtype=np.int64))
        seen, which = np.unique(code, return_inverse=True)
        patterns = (seen[:, None] >> np.arange(len(path)) & 1).astype(np.float64)
        parts = value * pattern_parts(np.array([p[3] for p in path]), patterns)
        out[:, features] += parts[which]


def contributions(df: DataFrame, model: Model, row_key: str) -> DataFrame:
    """row_key, base_value, margin, contributions (array<double> in the order of the model's features) for every row."""
    sent = configure(df.sparkSession).sparkContext.broadcast(model)
    slim = df.select(row_key, *[F.col(f"`{f}`").cast("double").alias(f"_x{i}") for i, f in enumerate(model.features)])
    schema = df.select(row_key).schema.add("base_value", "double").add("margin", "double").add("contributions", ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        base = base_value(m.trees)
        for batch in batches:
            bins = to_bins(_matrix(batch, [f"_x{i}" for i in range(len(m.features))]), m.edges)
            out = np.zeros(bins.shape)
            for tree in m.trees:
                tree_contributions(tree, bins, out)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, max(1, out.shape[1]), dtype=np.int32)), pa.array(out.ravel()))
            key = batch.column(batch.schema.get_field_index(row_key))
            yield pa.RecordBatch.from_arrays([key, pa.array(np.full(len(out), base)), pa.array(m.margins(bins)), lists], names=[row_key, "base_value", "margin", "contributions"])

    return slim.mapInArrow(run, schema)


def contribution_rows(found: DataFrame, model: Model, row_key: str) -> DataFrame:
    """row_key, feature, contribution: one row for each feature that moves a row's score."""
    names = F.array(*[F.lit(f) for f in model.features])
    pairs = found.select(row_key, F.posexplode("contributions").alias("_at", "contribution"))
    return pairs.where(F.col("contribution") != 0).select(row_key, F.get(names, F.col("_at")).alias("feature"), "contribution")


def contribution_summary(found: DataFrame, model: Model, row_key: str) -> DataFrame:
    """feature, mean_abs, and the quantiles of its contributions (the numbers behind a summary plot); partially aggregated."""
    rows = contribution_rows(found, model, row_key)
    quantiles = F.percentile_approx("contribution", [0.0, 0.25, 0.5, 0.75, 1.0], 1000)
    return rows.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"), quantiles.alias("quantiles"), F.count(F.lit(1)).alias("n"))
