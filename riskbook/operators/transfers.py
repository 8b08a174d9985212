"""Transfer feeds: clean (B2), daily pairs (B3), financial features (B4),
channel split (C1).

Plan shape of :func:`financial_features` for N feeds (checked with
``explain``): N pruned scans with the date filter pushed into Parquet →
Union → casts → amount filter → partial dedupe → **Exchange** on the full
row → final dedupe + partial sum/count → **Exchange** on the 10 keys →
final aggregate. Two shuffles for any N (the per-feed form needs 2 per
feed), and both sides of each shuffle combine map-side: a hot sender or
receiver is reduced to one row per map task before it moves, so one key
holding a third of the rows does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions.dates import in_window, window_start
from riskbook.sources.tables import write_table

# Output columns of the cleaned feed, with their types.
KEY_TYPES = [
    ("nr_cpf_cnpj_sender", "string"),
    ("nr_account_sender", "int"),
    ("nr_office_sender", "int"),
    ("cd_bank_sender", "int"),
    ("nr_cpf_cnpj_receiver", "string"),
    ("nr_account_receiver", "int"),
    ("nr_office_receiver", "int"),
    ("cd_bank_receiver", "int"),
]
GROUP_KEYS = [name for name, _ in KEY_TYPES] + ["dat_ref_carga"]
CHANNEL_COL = "tp_transacao"


def _typed(name: str, dtype: str) -> Column:
    # try_cast: a malformed number becomes null instead of failing the job
    # (plain cast raises under ANSI mode). Leading zeros vanish either way.
    if dtype == "string":
        return F.col(name).cast("string").alias(name)
    return F.col(name).try_cast(dtype).alias(name)


def _clean_columns(extra: Sequence[str] = ()) -> list[Column]:
    return (
        [F.col(c) for c in extra]
        + [_typed(n, t) for n, t in KEY_TYPES]
        + [F.col("vl_pgto").try_cast("double").alias("vl_titulo"), F.col("dat_ref_carga").cast("string").alias("dat_ref_carga")]
    )


def clean_transfers(raw: DataFrame, start: str, end: str, extra: Sequence[str] = ()) -> DataFrame:
    """B2: rows dated ``start..end`` (inclusive), typed, amount > 0, exact
    duplicates removed (there is no transfer id, so equal rows are replays).
    A malformed amount is null and so not above 0; malformed numbers elsewhere become null, the row stays.
    ``extra`` columns (such as the feed's name) come first and tell rows apart."""
    return (
        in_window(raw, start, end)
        .select(*_clean_columns(extra))
        .filter(F.col("vl_titulo") > 0)
        .dropDuplicates()
    )


def daily_pairs(clean: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Per sender account × receiver account × day: amount sum and count."""
    return clean.groupBy(*extra_keys, *GROUP_KEYS).agg(
        F.sum("vl_titulo").alias("vl_titulo"),
        F.count(F.lit(1)).cast("int").alias("qtd_titulo"),
    )


def _as_channels(feeds: Mapping[str, DataFrame] | Sequence[DataFrame]) -> list[tuple[str, DataFrame]]:
    if isinstance(feeds, Mapping):
        return list(feeds.items())
    return [(f"feed{i}", df) for i, df in enumerate(feeds)]


def financial_features(
    feeds: Mapping[str, DataFrame] | Sequence[DataFrame] | DataFrame,
    end_date: str,
    days_to_evaluate: int,
    channel_col: str | None = None,
) -> DataFrame:
    """Clean + daily pairs for any number of feeds, as one plan.

    The base window is ``days_to_evaluate + 1`` days back (so it holds
    ``days_to_evaluate + 2`` dates). Feeds are deduplicated and aggregated
    separately — equal rows in two feeds stay two rows — by carrying the
    feed name as a key, which is dropped at the end.

    ``feeds`` is a mapping name → table, a list of tables, or one table
    whose ``channel_col`` names the feed of each row (one scan for all
    feeds; the same result as splitting it first).
    """
    start = window_start(end_date, days=days_to_evaluate + 1)
    cols = [*[F.col(n) for n, _ in KEY_TYPES], "vl_pgto", "dat_ref_carga"]
    if isinstance(feeds, DataFrame):
        if channel_col is None:
            raise ValueError("a single feed table needs channel_col")
        tagged = in_window(feeds, start, end_date).select(F.col(channel_col).alias(CHANNEL_COL), *cols)
    else:
        tagged = None
        for name, raw in _as_channels(feeds):
            part = in_window(raw, start, end_date).select(F.lit(name).alias(CHANNEL_COL), *cols)
            tagged = part if tagged is None else tagged.unionByName(part)
    clean = tagged.select(*_clean_columns([CHANNEL_COL])).filter(F.col("vl_titulo") > 0).dropDuplicates()
    return daily_pairs(clean, extra_keys=[CHANNEL_COL]).drop(CHANNEL_COL)


def split_channels(df: DataFrame, column: str, values: Sequence[str]) -> dict[str, DataFrame]:
    """One table per channel value, the channel column removed.

    Each result is a filter on ``df`` (pushed into the scan). To materialise
    all of them in one pass use :func:`write_channels`.
    """
    return {v: df.filter(F.col(column) == v).drop(column) for v in values}


def write_channels(df: DataFrame, column: str, path: str) -> DataFrame:
    """C1 sink form: one pass, one directory per channel value
    (``path/column=value``); reading one channel back prunes partitions."""
    return write_table(df, path, partition_by=[column])
