"""Mergeable AUC state (D4, D5): counts of positives and negatives per score bucket.

A day's state is at most a few thousand rows however many customers were scored; states of days, feeds
or regions merge by adding counts, without the raw scores. The AUC of a state takes pairs within a bucket
as ties, so it differs from the exact one by at most ``error`` = half the share of such pairs, which the state gives, too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbook.functions.buckets import bucket

PER_OCTAVE = 1024


def auc_state(scored: DataFrame, score_col: str = "score", label_col: str = "label", group_cols: Sequence[str] = (), per_octave: int = PER_OCTAVE) -> DataFrame:
    """group, bucket, n_pos, n_neg: rows with a score and a label of 0 or 1. NaN scores rank above all others."""
    usable = scored.where(F.col(score_col).isNotNull() & F.col(label_col).isin(0, 1))
    number = F.when(F.isnan(F.col(score_col).cast("double")), F.lit((1 << 62))).otherwise(bucket(F.col(score_col), per_octave))
    return usable.groupBy(*group_cols, number.alias("bucket")).agg(
        F.sum((F.col(label_col) == 1).cast("long")).alias("n_pos"), F.sum((F.col(label_col) == 0).cast("long")).alias("n_neg")
    )


def merged(states: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """States of many groups as states of the groups of ``group_cols``."""
    return states.groupBy(*group_cols, "bucket").agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"))


def auc_of(state: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """group, n_pos, n_neg, roc_auc, error of a state; the window holds a group's buckets, never its scores."""
    below = Window.partitionBy(*group_cols).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranked = state.withColumn("_below", F.coalesce(F.sum("n_neg").over(below), F.lit(0)))
    wins = F.sum(F.col("n_pos").cast("double") * (F.col("_below") + F.col("n_neg") * 0.5))
    ties = F.sum(F.col("n_pos").cast("double") * F.col("n_neg"))
    total = ranked.groupBy(*group_cols).agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"), wins.alias("_w"), ties.alias("_t"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    share = lambda c: F.when(pairs > 0, c / pairs)
    return total.select(*group_cols, "n_pos", "n_neg", share(F.col("_w")).alias("roc_auc"), share(F.col("_t") * 0.5).alias("error"))
