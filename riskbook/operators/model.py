"""The risk model on the master table: assemble (D1), search and fit (D3), save / load (D6), feature
importance (D7), score (D8).

The reference pulls the master table into driver memory, runs a 30-trial
single-machine search and scores locally, writing predictions back into
the plan as literals. Here binning, training, cross-validation, scoring and explanation run on
the executors (:mod:`boosting`, :mod:`search`, :mod:`explain`);
only parameters, metrics and the trees reach the driver. Scores
are one scalar probability and label per customer (the reference puts
every prediction in an array on every row, Q2).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.operators import boosting, search
from riskbook.operators.boosting import Grower, Model, Params
from riskbook.operators.metrics import fold_of, roc_auc

__all__ = ["Model", "Params", "assembler", "feature_columns", "vector_to_array"]

ID = "nr_cpf_cnpj"
TARGET = "flag_bloqueio"
PATIENCE = search.PATIENCE
# Of a plain fit, one row in so many validates and stops the model early.
VALIDATION_FOLDS = 5


def feature_columns(df: DataFrame, exclude: Sequence[str] = (ID, TARGET, "fold")) -> list[str]:
    """Every column but the id, the target and the fold is a feature."""
    return [c for c in df.columns if c not in set(exclude)]


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def validation_rows(seed: int = 42) -> Column:
    """A fifth of the customers by hash of the id: the same ones on every run."""
    return fold_of(ID, VALIDATION_FOLDS, f"{seed}:validation") == 0


def fit(master: DataFrame, params: Params, target: str = TARGET, early_stop: bool = True) -> Model:
    """Fit with given parameters; by default a fifth of the customers validates, and the model stops after
    ``PATIENCE`` trees that did not lower their loss."""
    held = validation_rows(params.seed) if early_stop else None
    return boosting.fit(master, feature_columns(master, (ID, target, "fold")), target, ID, params, held, PATIENCE if early_stop else None)


@dataclass
class SearchResult:
    model: Model
    params: Params
    cv: DataFrame  # the trial table: search.ROWS
    in_sample_auc: float | None


def search_and_fit(
    master: DataFrame,
    n_trials: int = search.N_TRIALS,
    folds: int = 3,
    seed: int = 42,
    space: search.Space | None = None,
    target: str = TARGET,
    trials_path: str | None = None,
) -> SearchResult:
    """D3: search (mean k-fold AUC over hash folds, D2), refit of the best parameters on all rows with
    the folds' median number of trees, in-sample AUC of the refit."""
    features = feature_columns(master, (ID, target, "fold"))
    found, table, edges = search.search(master, features, target, ID, n_trials, folds, seed, space, trials_path=trials_path)
    params = replace(found.params, n_estimators=found.n_trees)
    grower = Grower(params, limit=found.n_trees)
    boosting.grow(table, [grower], len(features))
    model = Model(features, edges, grower.trees, params)
    row = roc_auc(score(master, model, keep=[target]), "probabilidade_inadimplente", target).first()
    return SearchResult(model, params, found.trials, row["roc_auc"] if row else None)


def save_model(model: Model, path: str, spark: SparkSession) -> str:
    """The fitted model as Parquet tables in a new folder."""
    return model.save(spark, path)


def load_model(path: str, spark: SparkSession) -> Model:
    """Reload a model saved by :func:`save_model`."""
    return Model.load(spark, path)


def feature_importance(model: Model, spark: SparkSession) -> DataFrame:
    """Feature, n_splits, total_gain, importance (share of the gain), one row per feature."""
    return boosting.gain_by_feature(model.table(spark), model.features)


def score(master: DataFrame, model: Model, cutoff: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """Probability of default and 0/1 label per customer, on the executors."""
    p = F.col("probability")
    return boosting.predict(master, model, [ID, *keep]).select(
        ID, *keep, p.alias("probabilidade_inadimplente"), (p >= F.lit(cutoff)).cast("int").alias("flag_predito")
    )
