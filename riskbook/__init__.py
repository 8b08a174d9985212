"""riskbook — customer-risk features, labels and scoring on Spark DataFrames.

Layout:

* ``riskbook.sources``   — table read/write, the shared folder, test fixtures.
* ``riskbook.functions`` — column-level helpers (dates, tax-id check digits,
  exact ranks, joins).
* ``riskbook.operators`` — the relational operators (transfers, behaviour,
  trailing book, master table, labels, metrics, model).
* ``riskbook.plans``     — compositions of operators: the feature run, the
  train/score run, the daily run, the query catalogue used by
  ``__spark_entry__``.

The most used entry points are re-exported here.
"""

from riskbook.operators.behavior import behavioral_features
from riskbook.operators.book import trailing_book
from riskbook.operators.labels import derive_labels
from riskbook.operators.master import master_table
from riskbook.operators.metrics import auc_by_date, needs_retrain, roc_auc
from riskbook.operators.transfers import financial_features
from riskbook.plans.daily import daily_run, run_from_folder
from riskbook.plans.features import build_features
from riskbook.plans.train import score_table, train

__all__ = [
    "auc_by_date",
    "behavioral_features",
    "build_features",
    "daily_run",
    "derive_labels",
    "financial_features",
    "master_table",
    "needs_retrain",
    "roc_auc",
    "run_from_folder",
    "score_table",
    "train",
    "trailing_book",
]
