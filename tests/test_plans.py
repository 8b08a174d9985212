"""The composed runs: feature plan with written intermediates, train gate."""

import os

import pytest
from pyspark.sql import functions as F

from riskbook.operators import metrics
from riskbook.operators.search import REFERENCE_SPACE
from riskbook.plans import catalog
from riskbook.plans.features import build_features
from riskbook.plans.train import score_table, train
from riskbook.session import scratch_path
from riskbook.sources import fixtures as fx
from riskbook.sources.tables import write_table
from tests.conftest import SF_SMALL


# Few trees, so that a search in a test takes seconds; the ranges of the library are the reference's.
SPACE = dict(REFERENCE_SPACE, n_estimators=(3, 5, True), max_depth=(2, 3, True))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_build_features_with_checkpoints_equals_lazy(spark):
    args = (
        fx.raw_channels(spark, SF_SMALL),
        fx.fixture(spark, SF_SMALL, "raw_campanhas"),
        fx.fixture(spark, SF_SMALL, "raw_riscos"),
        fx.fixture(spark, SF_SMALL, "flagged_table"),
        fx.END_DATE,
        fx.DAYS_TO_EVALUATE,
    )
    out = scratch_path(spark, "run")
    written = build_features(*args, checkpoint_to=out)
    lazy = build_features(*args)
    for name in ("financial", "behavioral", "agg_financial", "master_table"):
        assert os.path.isdir(f"{out}/{name}".replace("file:", ""))
    assert rows_of(written.master) == rows_of(lazy.master)
    tagged = build_features(fx.fixture(spark, SF_SMALL, "transfers_raw"), *args[1:], channel_col="tp_transacao")
    assert rows_of(tagged.master) == rows_of(lazy.master)
    assert rows_of(lazy.master) == rows_of(catalog.q_master_table(spark, SF_SMALL))


def test_train_gate_retrains_then_reuses(spark):
    master = write_table(catalog.labelled_master(spark, SF_SMALL), scratch_path(spark, "master"))
    path = scratch_path(spark, "model")

    first = train(master, None, fx.END_DATE, 0.85, path, folds=3, n_trials=2, space=SPACE)
    assert first.retrained and first.cv.count() == 2 and first.roc_auc is not None
    prev_day = "1998-06-29"
    good = spark.createDataFrame([(prev_day, 0.99)], "dat_ref_carga string, roc_auc double")
    second = train(master, good, fx.END_DATE, 0.85, path)
    assert not second.retrained and abs(second.roc_auc - first.roc_auc) < 1e-12
    bad = spark.createDataFrame([(prev_day, 0.5)], "dat_ref_carga string, roc_auc double")
    assert metrics.retrain_today(bad, fx.END_DATE, 0.85)
    assert metrics.retrain_today(good.filter(F.lit(False)), fx.END_DATE, 0.85)
    scores = score_table(master, path)
    assert scores.count() == master.count()
    assert scores.columns == ["nr_cpf_cnpj", "probabilidade_inadimplente", "flag_predito"]


def test_daily_run_gate_uses_yesterdays_history(spark):
    from riskbook.plans.daily import HISTORY_SCHEMA, daily_run

    args = (
        fx.raw_channels(spark, SF_SMALL),
        fx.fixture(spark, SF_SMALL, "raw_campanhas"),
        fx.fixture(spark, SF_SMALL, "raw_riscos"),
        fx.fixture(spark, SF_SMALL, "flagged_table"),
    )
    out = scratch_path(spark, "daily")
    kw = dict(days_to_evaluate=30, folds=3, n_trials=2, space=SPACE, out_dir=out)
    first = daily_run(spark, *args, end_date="1998-06-29", threshold=0.0, **kw)
    assert first.training.retrained
    n_master = first.features.master.count()
    assert first.scores.count() == n_master > 0
    # next day, yesterday's AUC >= threshold 0: reuse the saved model
    second = daily_run(spark, *args, end_date="1998-06-30", threshold=0.0, **kw)
    assert not second.training.retrained
    # two days later there is no history for the previous day: retrain
    third = daily_run(spark, *args, end_date="1998-07-02", threshold=0.0, **kw)
    assert third.training.retrained
    hist = {r.dat_ref_carga: r.roc_auc for r in spark.read.schema(HISTORY_SCHEMA).parquet(f"{out}/auc_history").collect()}
    assert set(hist) == {"1998-06-29", "1998-06-30", "1998-07-02"}
    assert second.training.model_path == first.training.model_path != third.training.model_path


def test_a_failing_save_leaves_the_promoted_model(spark, monkeypatch):
    from riskbook.operators import model
    from riskbook.plans.daily import daily_run

    args = (
        fx.raw_channels(spark, SF_SMALL),
        fx.fixture(spark, SF_SMALL, "raw_campanhas"),
        fx.fixture(spark, SF_SMALL, "raw_riscos"),
        fx.fixture(spark, SF_SMALL, "flagged_table"),
    )
    kw = dict(days_to_evaluate=30, folds=2, n_trials=1, space=SPACE, out_dir=scratch_path(spark, "daily"))
    first = daily_run(spark, *args, end_date="1998-06-29", threshold=0.0, **kw)

    def broken(fitted, path, spark):
        fitted.table(spark).write.parquet(path + "/trees")
        raise RuntimeError("lost while saving")

    monkeypatch.setattr(model, "save_model", broken)
    with pytest.raises(RuntimeError):
        daily_run(spark, *args, end_date="1998-06-30", threshold=1.1, **kw)
    monkeypatch.undo()
    assert score_table(first.features.master, first.training.model_path).count() == first.scores.count()
    again = daily_run(spark, *args, end_date="1998-06-30", threshold=0.0, **kw)
    assert not again.training.retrained and again.training.model_path == first.training.model_path


def test_run_from_folder_reads_named_tables_and_writes_outputs(spark):
    from riskbook.plans.daily import run_from_folder

    base = scratch_path(spark, "inputs")
    for ch, df in fx.raw_channels(spark, SF_SMALL).items():
        df.write.parquet(f"{base}/raw_{ch.lower()}")
    for name in ("raw_campanhas", "raw_riscos", "flagged_table"):
        fx.fixture(spark, SF_SMALL, name).write.parquet(f"{base}/{name}")
    out = scratch_path(spark, "outputs")
    run = run_from_folder(spark, base, out, fx.END_DATE, 180, 3, 0.85, n_trials=1, space=SPACE)
    day = f"{out}/{fx.END_DATE}"
    master = spark.read.parquet(f"{day}/master_table")
    assert rows_of(master) == rows_of(catalog.q_master_table(spark, SF_SMALL))
    assert spark.read.parquet(f"{day}/score_table").count() == master.count() == run.scores.count()
