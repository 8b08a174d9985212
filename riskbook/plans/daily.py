"""One daily run: features → train (gated) → score, with the named tables.

Layout below ``out_dir`` (a folder of the shared file system):

* ``<end_date>/financial``, ``behavioral``, ``agg_financial``,
  ``master_table``, ``score_table`` — the day's tables (overwrite);
* ``<end_date>/flagged``, ``riscos`` — the day's flagged list and risk table, written once
  and read by every step that needs them;
* ``model/<end_date>-<id>`` — one folder per fitted model, never overwritten;
* ``auc_history/dat_ref_carga=<day>`` — one row per run day with its AUC and the
  folder of the model in use. It is written after the model, so it promotes only models that
  were saved whole. The next day's gate reads it: retrain when yesterday is missing or below
  the threshold, else go on with yesterday's model (the data side of the reference's run tracking).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.functions.dates import window_start
from riskbook.plans.features import FeatureTables, build_features
from riskbook.plans.train import TrainRun, score_table, train
from riskbook.session import shared_dir
from riskbook.sources.tables import write_table


HISTORY_SCHEMA = "roc_auc double, model_path string, dat_ref_carga string"


@dataclass
class DailyRun:
    features: FeatureTables
    training: TrainRun
    scores: DataFrame


def _read_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing was written there yet. Any other
    failure to read it is an error, not a missing history."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def daily_run(
    spark: SparkSession,
    feeds: Mapping[str, DataFrame] | Sequence[DataFrame] | DataFrame,
    raw_campanhas: DataFrame,
    raw_riscos: DataFrame,
    flagged_table: DataFrame,
    end_date: str,
    days_to_evaluate: int = 180,
    threshold: float = 0.85,
    folds: int = 3,
    n_trials: int = 30,
    space: dict | None = None,
    cutoff: float = 0.5,
    out_dir: str | None = None,
    channel_col: str | None = None,
) -> DailyRun:
    out = (out_dir or os.path.join(shared_dir(spark), "riskbook")).rstrip("/")
    day_dir = f"{out}/{end_date}"
    flagged_table = write_table(flagged_table, f"{day_dir}/flagged")
    raw_riscos = write_table(raw_riscos, f"{day_dir}/riscos")
    tables = build_features(
        feeds, raw_campanhas, raw_riscos, flagged_table, end_date, days_to_evaluate, checkpoint_to=day_dir,
        channel_col=channel_col,
    )
    history_path = f"{out}/auc_history"
    # Explicit schema: the partition value stays an ISO string (discovery
    # would infer a date type).
    history = _read_or_none(spark, history_path, HISTORY_SCHEMA)
    yesterday = None
    if history is not None:
        yesterday = history.filter(F.col("dat_ref_carga") == window_start(end_date, days=1)).select("model_path").first()
    promoted = yesterday["model_path"] if yesterday else None
    run = train(
        tables.master, history if promoted else None, end_date, threshold, f"{out}/model/{end_date}-{uuid.uuid4().hex[:8]}",
        folds, n_trials, space=space, reuse_path=promoted, trials_path=f"{day_dir}/trials-{uuid.uuid4().hex[:8]}",
    )
    spark.createDataFrame([(run.roc_auc, run.model_path)], "roc_auc double, model_path string").write.mode("overwrite").parquet(
        f"{history_path}/dat_ref_carga={end_date}"
    )
    scores = write_table(score_table(tables.master, run.model_path, cutoff), f"{day_dir}/score_table")
    return DailyRun(tables, run, scores)


# Input table names below ``in_dir`` (one Parquet table each).
INPUT_TABLES = ("raw_pix", "raw_ted", "raw_doc", "raw_campanhas", "raw_riscos", "flagged_table")


def run_from_folder(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    end_date: str,
    days_to_evaluate: int = 180,
    number_of_folds: int = 3,
    threshold: float = 0.85,
    n_trials: int = 30,
    space: dict | None = None,
) -> DailyRun:
    """The whole job over named Parquet tables: ``in_dir/<name>`` for each of
    :data:`INPUT_TABLES`, outputs below ``out_dir`` (see :func:`daily_run`)."""
    from riskbook.sources.tables import read_table

    t = {name: read_table(spark, f"{in_dir.rstrip('/')}/{name}") for name in INPUT_TABLES}
    feeds = {"PIX": t["raw_pix"], "TED": t["raw_ted"], "DOC": t["raw_doc"]}
    return daily_run(
        spark,
        feeds,
        t["raw_campanhas"],
        t["raw_riscos"],
        t["flagged_table"],
        end_date,
        days_to_evaluate,
        threshold=threshold,
        folds=number_of_folds,
        n_trials=n_trials,
        space=space,
        out_dir=out_dir,
    )
