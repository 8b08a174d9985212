"""Date windows (B1) and the trailing-window list.

Dates travel as ``yyyy-MM-dd`` strings, compared lexically, as in the
reference's tables. Windows are inclusive at both ends: a window of ``n``
days back from ``end`` holds ``n + 1`` dates.
"""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The trailing windows (days) the book may hold.
POSSIBLE_WINDOWS = [1, 7, 15, 30, 60, 90, 180]

ISO = "%Y-%m-%d"
ISO_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _minus_months(d: date, months: int) -> date:
    total = d.year * 12 + (d.month - 1) - months
    year, month = divmod(total, 12)
    month += 1
    day = min(d.day, calendar.monthrange(year, month)[1])
    return date(year, month, day)


def window_start(end: str, days: int = 0, months: int = 0, years: int = 0) -> str:
    """``end`` minus ``days``, then minus ``months + 12 * years`` with the day
    clamped to the target month's end. Literal form, computed on the driver."""
    d = datetime.strptime(end, ISO).date() - timedelta(days=days)
    return _minus_months(d, months + 12 * years).strftime(ISO)


def window_start_col(end: Column, days: int = 0, months: int = 0, years: int = 0) -> Column:
    """Column form of :func:`window_start` for a column of ISO date strings."""
    d = F.date_sub(F.try_to_date(end, "yyyy-MM-dd"), days)  # malformed -> NULL, not a failed job
    total = months + 12 * years
    if total:
        d = F.add_months(d, -total)
    return F.date_format(d, "yyyy-MM-dd")


def window_list(days_to_evaluate: int, possible: list[int] | None = None) -> list[int]:
    """The possible windows that are not longer than ``days_to_evaluate``, which
    must be one of them."""
    choices = sorted(POSSIBLE_WINDOWS if possible is None else possible)
    if not any(w == days_to_evaluate for w in choices):
        raise ValueError(f"days_to_evaluate={days_to_evaluate} is not one of {choices}")
    return [w for w in choices if w <= days_to_evaluate]


def in_window(df: DataFrame, start: str, end: str, day_col: str = "dat_ref_carga") -> DataFrame:
    """The rows dated ``start..end`` (ISO days, both included), with ``day_col`` as an ISO string.

    Date and timestamp columns are compared as they are (so the bounds reach the
    Parquet scan) up to the end of the last day, and written as their day. Of string
    columns only ``yyyy-MM-dd`` values are days: anything else is in no window.
    """
    day = F.col(day_col)
    if isinstance(df.schema[day_col].dataType, StringType):
        return df.filter(day.between(start, end) & day.rlike(ISO_DAY))
    kept = df.filter((day >= F.lit(start).cast("date")) & (day < F.date_add(F.lit(end).cast("date"), 1)))
    return kept.withColumn(day_col, F.date_format(day, "yyyy-MM-dd"))
