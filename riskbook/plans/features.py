"""The feature run: raw feeds → financial → book, campaigns + risks →
behavioural → master table (the reference's feature stage as one call).

Everything stays lazy unless ``checkpoint_to`` is given: then the three
intermediate tables are written (overwrite) below that folder, as the
reference's named tables are, and later steps read them back, which cuts
the lineage (a lost executor re-runs only the current stage).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskbook.operators.behavior import behavioral_features
from riskbook.operators.book import trailing_book
from riskbook.operators.master import master_table
from riskbook.operators.transfers import financial_features
from riskbook.sources.tables import write_table


@dataclass
class FeatureTables:
    financial: DataFrame
    behavioral: DataFrame
    book: DataFrame
    master: DataFrame


def build_features(
    feeds: Mapping[str, DataFrame] | Sequence[DataFrame] | DataFrame,
    raw_campanhas: DataFrame,
    raw_riscos: DataFrame,
    flagged_table: DataFrame,
    end_date: str,
    days_to_evaluate: int,
    checkpoint_to: str | None = None,
    channel_col: str | None = None,
) -> FeatureTables:
    """``feeds``: name → table, a list of tables, or one table tagged by
    ``channel_col`` (see :func:`financial_features`)."""
    financial = financial_features(feeds, end_date, days_to_evaluate, channel_col=channel_col)
    behavioral = behavioral_features(raw_campanhas, raw_riscos, end_date, days_to_evaluate)
    if checkpoint_to:
        financial = write_table(financial, f"{checkpoint_to}/financial")
        behavioral = write_table(behavioral, f"{checkpoint_to}/behavioral")
    book = trailing_book(financial, flagged_table, end_date, days_to_evaluate)
    if checkpoint_to:
        book = write_table(book, f"{checkpoint_to}/agg_financial")
    master = master_table(behavioral, book)
    if checkpoint_to:
        master = write_table(master, f"{checkpoint_to}/master_table")
    return FeatureTables(financial, behavioral, book, master)
