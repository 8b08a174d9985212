"""Campaign and risk roll-ups: campaign_daily (B5), risk_window (B6),
behavioral_features (B7).

The reference joins daily campaign sums FULL OUTER with risk rows on
(customer, day), fills zeros, then aggregates per customer. A full outer
join cannot have its skewed partitions split by AQE, and it costs a third
shuffle. :func:`behavioral_features` computes the same numbers from one
UNION ALL and two partial-aggregating shuffles (customer-day, customer):

* per (customer, day) count the risk rows ``k``; the join repeats the
  campaign sums once per risk row, so campaign sums are multiplied by
  ``max(k, 1)`` (Q8: duplicate risk rows multiply campaign sums);
* the flag of a day is the max risk flag (nulls as 0), or 0 for a day
  with campaigns only;
* a null customer id never matches in a join, so its campaign and risk
  rows are not multiplied and its campaign-only rows add a 0 flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions.dates import in_window, window_start

ID, DAY = "nr_cpf_cnpj", "dat_ref_carga"


def _campaign_rows(raw_campanhas: DataFrame, start: str, end: str) -> DataFrame:
    return in_window(raw_campanhas, start, end).select(
        F.col(ID).cast("string").alias(ID),
        F.col("camp_disparo").try_cast("int").alias("camp_disparo"),
        F.col("camp_conversao").try_cast("int").alias("camp_conversao"),
        F.col(DAY).cast("string").alias(DAY),
    )


def campaign_daily(raw_campanhas: DataFrame, end_date: str, days_to_evaluate: int) -> DataFrame:
    """Campaigns sent / converted per customer-day in the base window."""
    start = window_start(end_date, days=days_to_evaluate + 1)
    return (
        _campaign_rows(raw_campanhas, start, end_date)
        .groupBy(ID, DAY)
        .agg(F.sum("camp_disparo").alias("qtd_camp_disparo"), F.sum("camp_conversao").alias("qtd_camp_conversao"))
    )


def risk_window(raw_riscos: DataFrame, end_date: str, days_to_evaluate: int) -> DataFrame:
    """Risk rows in the base window, typed; not deduplicated."""
    start = window_start(end_date, days=days_to_evaluate + 1)
    return in_window(raw_riscos, start, end_date).select(
        F.col(ID).cast("string").alias(ID),
        F.col("flag_bloqueio").try_cast("int").alias("flag_bloqueio"),
        F.col(DAY).cast("string").alias(DAY),
    )


def behavioral_features(
    raw_campanhas: DataFrame,
    raw_riscos: DataFrame,
    end_date: str,
    days_to_evaluate: int,
) -> DataFrame:
    """Per customer, campaigns sent and converted (bigint) and the
    max risk flag (int), over the base window."""
    start = window_start(end_date, days=days_to_evaluate + 1)
    null_int = F.lit(None).cast("int")
    camp = _campaign_rows(raw_campanhas, start, end_date).select(
        ID, DAY, "camp_disparo", "camp_conversao", null_int.alias("flag"), F.lit(1).alias("is_camp"), F.lit(0).alias("is_risk")
    )
    risk = risk_window(raw_riscos, end_date, days_to_evaluate).select(
        ID,
        DAY,
        null_int.alias("camp_disparo"),
        null_int.alias("camp_conversao"),
        F.col("flag_bloqueio").alias("flag"),
        F.lit(0).alias("is_camp"),
        F.lit(1).alias("is_risk"),
    )
    per_day = camp.unionByName(risk).groupBy(ID, DAY).agg(
        F.coalesce(F.sum("camp_disparo"), F.lit(0)).alias("sd"),
        F.coalesce(F.sum("camp_conversao"), F.lit(0)).alias("sc"),
        F.sum("is_camp").alias("n_camp"),
        F.sum("is_risk").alias("n_risk"),
        F.max(F.when(F.col("is_risk") == 1, F.coalesce(F.col("flag"), F.lit(0)))).alias("mf"),
    )
    has_camp = F.col("n_camp") > 0
    has_risk = F.col("n_risk") > 0
    matched = F.col(ID).isNotNull() & has_risk
    mult = F.when(matched, F.col("n_risk")).otherwise(F.lit(1).cast("bigint"))
    day_flag = (
        F.when(has_risk & has_camp & ~matched, F.greatest(F.col("mf"), F.lit(0)))
        .when(has_risk, F.col("mf"))
        .otherwise(F.lit(0))
    )
    return per_day.groupBy(ID).agg(
        F.sum(F.col("sd") * mult).alias("qtd_camp_disparo"),
        F.sum(F.col("sc") * mult).alias("qtd_camp_conversao"),
        F.max(day_flag).cast("int").alias("flag_bloqueio"),
    )
