"""Model evaluation on tables: exact ROC AUC (D4), AUC by date and the
retrain gate (D5), threshold labels (D9), hash folds (D2).

``roc_auc`` is the Mann-Whitney statistic with ties counted half — what
the reference computes on the driver with a single-machine library — as a
distributed aggregation: counts per (group, score), sorted ranges of the distinct
scores, a running count of negatives inside each range, and offsets from one
row per (range, group).

AUC = Σ pos(s) · (neg(< s) + ½ neg(s)) / (P · N), NULL when a group holds
one class only. No task holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.functions.dates import window_start
from riskbook.functions.ranking import hash_hex, hash_int, in_ranges

def roc_auc(scored: DataFrame, score_col: str = "score", label_col: str = "label", group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``n_pos``, ``n_neg``, ``n_unusable``, ``roc_auc`` (double).

    Scores may be any numbers; NaN ranks above all others, as Spark and SQL order
    it. Rows without a score or with a label other than 0 and 1 cannot be ranked;
    ``n_unusable`` counts them. Equal scores are one row before anything is sorted, so
    neither a group nor a score that holds a third of the rows lands in one task.
    """
    g = list(group_cols)
    usable = F.col(score_col).isNotNull() & F.coalesce(F.col(label_col).isin(0, 1), F.lit(False))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    per_score = scored.groupBy(*g, F.col(score_col).alias("_s")).agg(
        count(usable & (F.col(label_col) == 1)).alias("_pos"),
        count(usable & (F.col(label_col) == 0)).alias("_neg"),
        count(~usable).alias("_bad"),
    )
    placed = in_ranges(per_score, *g, "_s")
    inside = Window.partitionBy("_part", *g).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(inside), F.lit(0)).cast("double") + F.col("_neg") * 0.5
    parts = (
        placed.withColumn("_u", F.col("_pos") * below)
        .groupBy(*g, "_part")
        .agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"), F.sum("_bad").alias("_x"), F.sum("_u").alias("_u"))
    )
    # One row per range and group: positives of a range beat the negatives of the ranges below.
    before = Window.partitionBy(*g).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("double")
    total = (
        parts.withColumn("_u", F.col("_u") + F.col("_p").cast("double") * lower)
        .groupBy(*g)
        .agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"), F.sum("_x").alias("_x"), F.sum("_u").alias("_u"))
    )
    denom = F.col("_p").cast("double") * F.col("_n").cast("double")
    return total.select(
        *g,
        F.coalesce("_p", F.lit(0)).cast("bigint").alias("n_pos"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_neg"),
        F.coalesce("_x", F.lit(0)).cast("bigint").alias("n_unusable"),
        F.when(denom > 0, F.col("_u") / denom).alias("roc_auc"),
    )


def auc_by_date(history: DataFrame, date_col: str = "dat_ref_carga", **kw) -> DataFrame:
    """D5, first half: AUC per date of a score history."""
    return roc_auc(history, group_cols=[date_col], **kw)


def needs_retrain(daily_auc: DataFrame, threshold: float, date_col: str = "dat_ref_carga") -> DataFrame:
    """D5, gate: for every date, retrain (``fl_retreinar`` = 1) when the
    previous calendar day has no AUC, a NULL AUC, or one below ``threshold``.

    The previous day is matched by calendar (``date + 1``), not by row
    order, so a missing day counts as missing, as in the reference's lookup
    by date tag. One pass: every daily row is emitted for its own date and,
    tagged as "previous", for the next date, then grouped by date.
    """
    day = F.try_to_date(F.col(date_col), "yyyy-MM-dd")  # malformed -> NULL
    tagged = daily_auc.select(
        F.explode(
            F.array(
                F.struct(F.col(date_col).alias("d"), F.lit(True).alias("own"), F.col("roc_auc").alias("auc")),
                F.struct(
                    F.date_format(F.date_add(day, 1), "yyyy-MM-dd").alias("d"),
                    F.lit(False).alias("own"),
                    F.col("roc_auc").alias("auc"),
                ),
            )
        ).alias("t")
    ).select("t.*")
    per_day = tagged.groupBy(F.col("d").alias(date_col)).agg(
        F.max(F.col("own").cast("int")).alias("_own"),
        F.max(F.when(F.col("own"), F.col("auc"))).alias("roc_auc"),
        F.max(F.when(~F.col("own"), F.col("auc"))).alias("roc_auc_anterior"),
        F.max(F.when(~F.col("own"), F.lit(1))).alias("_has_prev"),
    )
    retrain = F.col("roc_auc_anterior").isNull() | (F.col("roc_auc_anterior") < threshold)
    return per_day.filter(F.col("_own") == 1).select(
        date_col, "roc_auc", "roc_auc_anterior", retrain.cast("int").alias("fl_retreinar")
    )


def retrain_today(daily_auc: DataFrame, end_date: str, threshold: float, date_col: str = "dat_ref_carga") -> bool:
    """The gate for one run date: looks up the previous day's AUC (one row)."""
    prev_day = window_start(end_date, days=1)
    row = daily_auc.filter(F.col(date_col) == prev_day).select("roc_auc").first()
    return row is None or row[0] is None or row[0] < threshold


def threshold_label(df: DataFrame, score_col: str, cutoff: float = 0.5, out_col: str = "flag_predito") -> DataFrame:
    """1 when the score is at least ``cutoff``, else 0 (NULL stays NULL)."""
    return df.withColumn(out_col, (F.col(score_col) >= F.lit(cutoff)).cast("int"))


def fold_of(id_col: str | Column, k: int, seed: int | str = 42) -> Column:
    """Fold in ``0..k-1`` from ``md5(id:seed)``; a shuffled k-fold that
    needs no sort and gives every row the same fold on every run."""
    return (hash_int(hash_hex(id_col, F.lit(str(seed))), 8) % F.lit(k)).cast("int")


def assign_fold(df: DataFrame, id_col: str, k: int, seed: int | str = 42, out_col: str = "fold") -> DataFrame:
    return df.withColumn(out_col, fold_of(id_col, k, seed))
