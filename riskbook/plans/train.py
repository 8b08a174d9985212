"""Train and score runs (the reference's train and score stages).

``train`` applies the retrain gate (previous day's AUC missing or below the
threshold → search and refit; otherwise reuse the saved model and only
measure it), saves the model below ``model_dir`` and returns the metrics.
``score_table`` applies a saved model to a master table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskbook.operators import metrics, model
from riskbook.operators.boosting import Model, Params


@dataclass
class TrainRun:
    model: Model
    model_path: str
    retrained: bool
    roc_auc: float | None
    params: Params | None
    cv: DataFrame | None


def train(
    master: DataFrame,
    daily_auc: DataFrame | None,
    end_date: str,
    threshold: float,
    model_path: str,
    folds: int = 3,
    n_trials: int = 30,
    seed: int = 42,
    space: dict | None = None,
    reuse_path: str | None = None,
    trials_path: str | None = None,
) -> TrainRun:
    """A new model is saved at ``model_path``; the one to go on with, if the gate
    allows it, is at ``reuse_path`` (by default the same place). A search that was cut off goes on from its
    trial table at ``trials_path``."""
    spark = master.sparkSession
    retrain = daily_auc is None or metrics.retrain_today(daily_auc, end_date, threshold)
    if retrain:
        res = model.search_and_fit(master, n_trials=n_trials, folds=folds, seed=seed, space=space, trials_path=trials_path)
        model.save_model(res.model, model_path, spark)
        return TrainRun(res.model, model_path, True, res.in_sample_auc, res.params, res.cv)
    current = reuse_path or model_path
    fitted = model.load_model(current, spark)
    row = metrics.roc_auc(model.score(master, fitted, keep=[model.TARGET]), "probabilidade_inadimplente", model.TARGET).first()
    return TrainRun(fitted, current, False, row["roc_auc"] if row else None, None, None)


def score_table(master: DataFrame, model_path: str, cutoff: float = 0.5) -> DataFrame:
    """(nr_cpf_cnpj, probabilidade_inadimplente, flag_predito) per customer."""
    return model.score(master, model.load_model(model_path, master.sparkSession), cutoff)
