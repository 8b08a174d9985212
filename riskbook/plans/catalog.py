"""Query catalogue: every operator of the survey run over the fixture views
of one scale-factor folder. Each entry takes ``(spark, sf_dir)`` and returns
a DataFrame; ``riskbook.plans.oracle_sql`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.functions.dates import window_start, window_start_col
from riskbook.functions.outer import full_outer
from riskbook.operators import behavior, book, boosting, explain, labels, master, metrics, model, transfers
from riskbook.operators.asof_book import book_as_of
from riskbook.operators.auc_state import auc_of, auc_state, merged
from riskbook.operators.boosting import Model, Params
from riskbook.plans.incremental import add_batch, financial_as_of
from riskbook.plans.train import train
from riskbook.session import scratch_path
from riskbook.sources.tables import write_table
from riskbook.sources.versions import current_table, read_or_create, replace_table
from riskbook.sources import fixtures as fx
from riskbook.sources.fixtures import DAYS_TO_EVALUATE as DAYS
from riskbook.sources.fixtures import END_DATE

Query = Callable[[SparkSession, str], DataFrame]

# Extra (days, months, years) offsets shown by window_bounds,
# chosen to hit month-end clamping.
BOUND_OFFSETS = {
    "start_1d": (1, 0, 0),
    "start_181d": (181, 0, 0),
    "start_1m": (0, 1, 0),
    "start_3m": (0, 3, 0),
    "start_1y": (0, 0, 1),
    "start_30d_1m": (30, 1, 0),
    "start_1d_1m_1y": (1, 1, 1),
}


# End dates of book_as_of: neighbours, a month end and a leap of months.
AS_OF = [END_DATE, "1998-06-29", "1998-05-31", "1998-03-01"]


def base_start() -> str:
    return window_start(END_DATE, days=DAYS + 1)


# ------------------------------------------------------------------ features


def q_window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fx.fixture(spark, sf_dir, "transfers").select("dat_ref_carga").distinct()
    cols = [window_start_col(F.col("dat_ref_carga"), d, m, y).alias(name) for name, (d, m, y) in BOUND_OFFSETS.items()]
    return days.select("dat_ref_carga", *cols)


def q_clean_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds, each row with its feed."""
    return transfers.clean_transfers(fx.fixture(spark, sf_dir, "transfers_raw"), base_start(), END_DATE, extra=["tp_transacao"])


def q_clean_transfers_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feeds with times of day: the whole end date counts, days stay days."""
    raw = fx.fixture(spark, sf_dir, "transfers_raw")
    hours = F.pmod(F.col("vl_pgto").cast("int"), F.lit(24))
    timed = raw.withColumn("dat_ref_carga", F.col("dat_ref_carga").cast("timestamp") + F.make_dt_interval(hours=hours))
    return transfers.clean_transfers(timed, base_start(), END_DATE, extra=["tp_transacao"])


def q_clean_transfers_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds with missing senders, malformed numbers and malformed amounts."""
    return transfers.clean_transfers(fx.fixture(spark, sf_dir, "transfers_malformed"), base_start(), END_DATE, extra=["tp_transacao"])


def q_trailing_book_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book of those feeds: senders without id keep one all-zero row."""
    fin = transfers.financial_features(fx.fixture(spark, sf_dir, "transfers_malformed"), END_DATE, DAYS, channel_col="tp_transacao")
    return book.trailing_book(fin, fx.fixture(spark, sf_dir, "flagged_table"), END_DATE, DAYS)


def q_daily_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers.daily_pairs(q_clean_transfers(spark, sf_dir), extra_keys=["tp_transacao"])


def q_financial_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The fixture feeds come as one table tagged by channel: one scan.
    return transfers.financial_features(fx.fixture(spark, sf_dir, "transfers_raw"), END_DATE, DAYS, channel_col="tp_transacao")


def q_financial_features_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-table form: one table per feed."""
    return transfers.financial_features(fx.raw_channels(spark, sf_dir), END_DATE, DAYS)


def q_campaign_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior.campaign_daily(fx.fixture(spark, sf_dir, "raw_campanhas"), END_DATE, DAYS)


def q_risk_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior.risk_window(fx.fixture(spark, sf_dir, "raw_riscos"), END_DATE, DAYS)


def q_behavioral_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior.behavioral_features(
        fx.fixture(spark, sf_dir, "raw_campanhas"), fx.fixture(spark, sf_dir, "raw_riscos"), END_DATE, DAYS
    )


def q_mark_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.mark_flagged(q_financial_features(spark, sf_dir), fx.fixture(spark, sf_dir, "flagged_table"))


def q_own_bank_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.mark_own_bank(q_financial_features(spark, sf_dir))


def q_trailing_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.trailing_book(q_financial_features(spark, sf_dir), fx.fixture(spark, sf_dir, "flagged_table"), END_DATE, DAYS)


def q_book_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B11 for several end dates in one plan."""
    span = (date.fromisoformat(max(AS_OF)) - date.fromisoformat(min(AS_OF))).days + DAYS
    fin = transfers.financial_features(fx.fixture(spark, sf_dir, "transfers_raw"), max(AS_OF), span, channel_col="tp_transacao")
    return book_as_of(fin, fx.fixture(spark, sf_dir, "flagged_table"), AS_OF, DAYS)


def q_trailing_book_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another length: the windows up to 30 days, over a base window of 30 days."""
    fin = transfers.financial_features(fx.raw_channels(spark, sf_dir), END_DATE, 30)
    return book.trailing_book(fin, fx.fixture(spark, sf_dir, "flagged_table"), END_DATE, 30)


def q_master_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.master_table(q_behavioral_features(spark, sf_dir), q_trailing_book(spark, sf_dir))


def q_class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.class_balance(q_master_table(spark, sf_dir))


def q_split_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every channel's table, with the channel named again."""
    parts = transfers.split_channels(fx.fixture(spark, sf_dir, "transfers_raw"), "tp_transacao", list(fx.CHANNELS))
    named = [df.withColumn("tp_transacao", F.lit(name)) for name, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


def q_write_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 sink form: one partitioned write, all channels read back."""
    return transfers.write_channels(fx.fixture(spark, sf_dir, "transfers_raw"), "tp_transacao", scratch_path(spark, "channels"))


# -------------------------------------------------------------------- labels


def q_received_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.received_by_type(fx.fixture(spark, sf_dir, "transfers"), fx.fixture(spark, sf_dir, "persons"), "J")


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.receiver_totals(fx.fixture(spark, sf_dir, "transfers"), fx.fixture(spark, sf_dir, "persons"), "J")


def q_receiver_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(spark, sf_dir)


def q_rank_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.rank_band(_totals(spark, sf_dir), fx.RANK_LO, fx.RANK_HI)


def q_rank_band_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A band below the first thousand places: the same plan."""
    return labels.rank_band(_totals(spark, sf_dir), fx.DEEP_LO, fx.DEEP_HI)


def q_last_flagged_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.last_flagged_transfer(fx.fixture(spark, sf_dir, "transfers"), q_rank_band(spark, sf_dir))


def q_sample_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.sample_customers(
        fx.fixture(spark, sf_dir, "persons"), fx.fixture(spark, sf_dir, "transfers"), fx.SAMPLE_FRACTION, fx.SEED
    )


def q_derive_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.derive_labels(
        fx.fixture(spark, sf_dir, "persons"),
        fx.fixture(spark, sf_dir, "transfers"),
        fx.RANK_LO,
        fx.RANK_HI,
        fx.SAMPLE_FRACTION,
        fx.SEED,
    ).risks


def q_check_tax_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.check_tax_ids(fx.fixture(spark, sf_dir, "tax_ids"))


# ------------------------------------------------------------- model inputs


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fixture(spark, sf_dir, "score_history")


def q_assign_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.assign_fold(q_master_table(spark, sf_dir).select("nr_cpf_cnpj"), "nr_cpf_cnpj", fx.FOLDS, fx.SEED)


def q_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_month = _scores(spark, sf_dir).withColumn("mes", F.substring("dat_ref_carga", 1, 7))
    return metrics.roc_auc(by_month, "score", "label", ["mes"])


def q_roc_auc_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores far outside [0, 1], and labels that cannot be ranked."""
    return metrics.roc_auc(fx.fixture(spark, sf_dir, "score_margins"), "score", "label", ["mes"])


def q_auc_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.auc_by_date(_scores(spark, sf_dir), "dat_ref_carga", score_col="score", label_col="label")


def q_needs_retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.needs_retrain(q_auc_by_date(spark, sf_dir), fx.RETRAIN_THRESHOLD)


def q_threshold_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.threshold_label(_scores(spark, sf_dir), "score", fx.CUTOFF)


def q_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the financial table written (overwrite) to the shared folder and read back."""
    return write_table(q_financial_features(spark, sf_dir), scratch_path(spark, "financial"))


def q_table_roundtrip_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the financial table partitioned by day; types, values and column order stay."""
    return write_table(q_financial_features(spark, sf_dir), scratch_path(spark, "financial-days"), partition_by=["dat_ref_carga"])


def written_labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The derived flagged list and risk table as named tables, written once."""
    derived = labels.derive_labels(
        fx.fixture(spark, sf_dir, "persons"), fx.fixture(spark, sf_dir, "transfers"), fx.RANK_LO, fx.RANK_HI,
        fx.SAMPLE_FRACTION, fx.SEED,
    )
    flagged = write_table(derived.flagged, scratch_path(spark, "flagged"))
    return flagged, write_table(derived.risks, scratch_path(spark, "riscos"))


def labelled_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master table whose risks are the labels derived from transfers (C7),
    as in the reference, where the derived risk table feeds the features."""
    flagged, risks = written_labels(spark, sf_dir)
    beh = behavior.behavioral_features(fx.fixture(spark, sf_dir, "raw_campanhas"), risks, END_DATE, DAYS)
    return master.master_table(beh, book.trailing_book(q_financial_features(spark, sf_dir), flagged, END_DATE, DAYS))


# A single fit from within the reference's ranges, stopped early by the validation rows.
FIT_PARAMS = Params(n_estimators=100, max_depth=3, learning_rate=0.3, gamma=0.5, subsample=0.8, colsample_bytree=0.8, seed=fx.SEED)
# Few trees with every regularising term, so that SQL can grow the same ones.
SQL_PARAMS = Params(n_estimators=3, max_depth=3, learning_rate=0.3, gamma=0.25, subsample=0.8, colsample_bytree=0.7, reg_alpha=0.1, reg_lambda=1.5, seed=fx.SEED)


def q_gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D3 + D6 + D8: fit, save to the shared folder, reload, score."""
    m = write_table(labelled_master(spark, sf_dir), scratch_path(spark, "master"))
    path = model.save_model(model.fit(m, FIT_PARAMS), scratch_path(spark, "gbt"), spark)
    return model.score(m, model.load_model(path, spark), fx.CUTOFF)


def q_assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature of the assembled vector, as (id, feature, value)."""
    m = labelled_master(spark, sf_dir)
    names = model.feature_columns(m)
    vector = model.assembler(names).transform(m).select("nr_cpf_cnpj", model.vector_to_array("features").alias("value"))
    pairs = vector.select("nr_cpf_cnpj", F.posexplode("value").alias("at", "value"))
    return pairs.select("nr_cpf_cnpj", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("at") + 1).alias("feature"), "value")


def _fitted(spark: SparkSession, sf_dir: str, params: Params, early_stop: bool) -> tuple[DataFrame, Model]:
    m = write_table(labelled_master(spark, sf_dir), scratch_path(spark, "master"))
    return m, model.fit(m, params, early_stop=early_stop)


def q_score_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 + D8: probability and label of every customer; the oracle grows the same trees in SQL."""
    m, fitted = _fitted(spark, sf_dir, SQL_PARAMS, False)
    return model.score(m, fitted, fx.CUTOFF).withColumn("probabilidade_inadimplente", F.round("probabilidade_inadimplente", 9))


def q_model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The margins of the model read back from its tables."""
    m, fitted = _fitted(spark, sf_dir, SQL_PARAMS, False)
    again = model.load_model(model.save_model(fitted, scratch_path(spark, "gbt"), spark), spark)
    return boosting.predict(m, again, ["nr_cpf_cnpj"]).select("nr_cpf_cnpj", F.round("margin", 9).alias("margin"))


def q_importance_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits and gain of every feature."""
    _, fitted = _fitted(spark, sf_dir, SQL_PARAMS, False)
    return model.feature_importance(fitted, spark).select("feature", "n_splits", F.round("total_gain", 6).alias("total_gain"), F.round("importance", 6).alias("importance"))


def q_contribution_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base value plus contributions of every customer; the oracle has the margins of its own trees."""
    m, fitted = _fitted(spark, sf_dir, SQL_PARAMS, False)
    found = explain.contributions(m, fitted, "nr_cpf_cnpj")
    total = F.aggregate("contributions", F.col("base_value"), lambda a, x: a + x)
    return found.select("nr_cpf_cnpj", F.round(total, 9).alias("margin"))


def q_gate_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 + D6: a day whose previous day has a good AUC goes on with that day's model and measures it."""
    m, fitted = _fitted(spark, sf_dir, SQL_PARAMS, False)
    path = model.save_model(fitted, scratch_path(spark, "gbt"), spark)
    history = spark.createDataFrame([(window_start(END_DATE, days=1), 1.0)], "dat_ref_carga string, roc_auc double")
    run = train(m, history, END_DATE, fx.RETRAIN_THRESHOLD, scratch_path(spark, "unused"), reuse_path=path)
    return spark.createDataFrame([(END_DATE, int(run.retrained), int(run.model_path == path), run.roc_auc)], "dat_ref_carga string, retrained int, same_model int, roc_auc double").withColumn("roc_auc", F.round("roc_auc", 9))


def q_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.feature_importance(_fitted(spark, sf_dir, FIT_PARAMS, True)[1], spark)


def q_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each feature adds to each customer's score."""
    m, fitted = _fitted(spark, sf_dir, FIT_PARAMS, True)
    return explain.contribution_rows(explain.contributions(m, fitted, "nr_cpf_cnpj"), fitted, "nr_cpf_cnpj")


def q_cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 + D3: the trial table of the whole search."""
    m = write_table(labelled_master(spark, sf_dir), scratch_path(spark, "master"))
    return model.search_and_fit(m, folds=fx.FOLDS, seed=fx.SEED).cv


def q_daily_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's full run: features → gated training → scoring, with
    the derived labels and flagged list as its risk and flagged inputs. A
    fresh output folder per call, so the gate always starts without history
    (it retrains)."""
    from riskbook.plans.daily import daily_run

    flagged, risks = written_labels(spark, sf_dir)
    run = daily_run(
        spark,
        fx.raw_channels(spark, sf_dir),
        fx.fixture(spark, sf_dir, "raw_campanhas"),
        risks,
        flagged,
        END_DATE,
        DAYS,
        threshold=fx.RETRAIN_THRESHOLD,
        folds=fx.FOLDS,
        cutoff=fx.CUTOFF,
        out_dir=scratch_path(spark, "daily"),
    )
    return run.scores


def q_table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: a table replaced twice, the second time from itself, with a failing write between."""
    path = scratch_path(spark, "replaced")
    replace_table(q_financial_features(spark, sf_dir).withColumn("vl_titulo", F.lit(0.0)), path)
    replace_table(q_financial_features(spark, sf_dir).withColumn("vl_titulo", F.col("vl_titulo") * 2), path)
    try:
        broken = F.when(F.col("vl_titulo") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.lit(0.0)).cast("double")
        replace_table(current_table(spark, path).withColumn("vl_titulo", broken), path)
    except PySparkException:
        pass  # the table is as it was: that is what the next line reads
    return replace_table(current_table(spark, path).withColumn("vl_titulo", F.col("vl_titulo") / 2), path)


def q_incremental_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2-B4 batch by batch: three batches that overlap, one of them run twice. The feed is a written table, as in
    production: its rows are put together once, not for every batch."""
    state, feed = scratch_path(spark, "state"), scratch_path(spark, "feed")
    fx.fixture(spark, sf_dir, "transfers_raw").write.option("compression", "zstd").parquet(feed)
    raw = spark.read.parquet(feed)
    part = F.pmod(F.crc32(F.concat_ws("|", "nr_cpf_cnpj_sender", "dat_ref_carga").cast("binary")), F.lit(4))
    for name, mine in (("a", part.isin(0, 1)), ("b", part.isin(1, 2)), ("b", part.isin(1, 2)), ("c", part.isin(0, 3))):
        add_batch(raw.where(F.coalesce(mine, F.lit(False))), state, name, "tp_transacao")
    return financial_as_of(spark, state, END_DATE, DAYS)


def q_read_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read-or-create: the second call reads what the first one made."""
    path = scratch_path(spark, "made")
    read_or_create(q_financial_features(spark, sf_dir), path)
    return read_or_create(q_financial_features(spark, sf_dir), path)


def q_full_outer_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FULL OUTER with a third of the rows under one key, null and unmatched keys, and repeated rows."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "case when o_orderkey % 7 = 0 then null when o_orderkey % 3 = 0 then 1 else o_custkey + 1 end as left_key", "o_orderstatus"
    )
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("case when c_custkey % 11 = 0 then null else c_custkey end as right_key", "c_nationkey")
    return full_outer(orders, customers, ["left_key"], ["right_key"])


def q_auc_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly AUC from the daily states, and its bound."""
    daily = auc_state(fx.fixture(spark, sf_dir, "score_history"), group_cols=["dat_ref_carga"])
    months = daily.withColumn("mes", F.substring("dat_ref_carga", 1, 7))
    return auc_of(merged(months, ["mes"]), ["mes"]).withColumns({c: F.round(c, 9) for c in ("roc_auc", "error")})


QUERIES: dict[str, Query] = {
    "window_bounds": q_window_bounds,  # B1 (column form, every transfer day)
    "clean_transfers": q_clean_transfers,  # B2
    "clean_transfers_timestamps": q_clean_transfers_timestamps,  # B2, dates with times
    "clean_transfers_malformed": q_clean_transfers_malformed,  # B2, malformed numbers (Q9)
    "daily_pairs": q_daily_pairs,  # B3
    "financial_features": q_financial_features,  # B4
    "financial_features_feeds": q_financial_features_feeds,  # B4, one table per feed
    "campaign_daily": q_campaign_daily,  # B5
    "risk_window": q_risk_window,  # B6
    "behavioral_features": q_behavioral_features,  # B7
    "mark_flagged": q_mark_flagged,  # B8
    "own_bank_flag": q_own_bank_flag,  # B9
    "trailing_book": q_trailing_book,  # B10 + B11 + B12
    "trailing_book_malformed": q_trailing_book_malformed,  # B11 + B12, senders without id (Q10)
    "book_as_of": q_book_as_of,  # B11, several end dates
    "trailing_book_30": q_trailing_book_30,  # B10 + B11 at another length
    "master_table": q_master_table,  # B13
    "labelled_master": labelled_master,  # C7 into B7, B11 and B13
    "class_balance": q_class_balance,  # B14
    "split_channels": q_split_channels,  # C1
    "write_channels": q_write_channels,  # C1 sink
    "received_by_type": q_received_by_type,  # C2
    "receiver_totals": q_receiver_totals,  # C3
    "rank_band": q_rank_band,  # C4
    "rank_band_deep": q_rank_band_deep,  # C4 beyond the first thousand places
    "last_flagged_transfer": q_last_flagged_transfer,  # C5
    "sample_customers": q_sample_customers,  # C6
    "derive_labels": q_derive_labels,  # C7
    "check_tax_ids": q_check_tax_ids,  # C8
    "assign_fold": q_assign_fold,  # D2
    "roc_auc": q_roc_auc,  # D4
    "roc_auc_margins": q_roc_auc_margins,  # D4, any scores
    "auc_by_date": q_auc_by_date,  # D5
    "needs_retrain": q_needs_retrain,  # D5 gate
    "threshold_label": q_threshold_label,  # D9
    "table_roundtrip": q_table_roundtrip,  # A2 write + A1 read back
    "table_roundtrip_partitioned": q_table_roundtrip_partitioned,  # A2 partitioned
    "table_replaced": q_table_replaced,  # A2, committed versions
    "incremental_features": q_incremental_features,  # B2 + B3 + B4, batch by batch
    "read_or_create": q_read_or_create,  # 2.1, made once
    "full_outer_hot": q_full_outer_hot,  # 2.3, FULL OUTER on hot keys
    "auc_sketch": q_auc_sketch,  # D4 + D5, mergeable state
    "assembled_features": q_assembled_features,  # D1
    "score_contract": q_score_contract,  # D8
    "model_reload": q_model_reload,  # D6
    "importance_names": q_importance_names,  # D7
    "contribution_sums": q_contribution_sums,  # D7, per customer
    "gate_reuse": q_gate_reuse,  # D5 + D6, the second day
    "contributions": q_contributions,  # D7, per customer (rows-only)
    "gbt_scores": q_gbt_scores,  # D1 + D6 + D8 (rows-only)
    "feature_importance": q_feature_importance,  # D7 (rows-only)
    "cv_metrics": q_cv_metrics,  # D2 + D3 (rows-only)
    "daily_scores": q_daily_scores,  # the full run (rows-only)
}

__all__ = ["QUERIES"]
