"""The trailing book as of many end dates at once (B11 for each date, 2.5).

One book reads every row of its windows; books of a year of end dates would read each transfer hundreds of
times. Here the day rows of a sender are summed once into a tree of days: level k holds blocks of
2**k days (day number div 2**k). Any window of n days is the union of at most 2 log2(n) + 2 blocks, so a
(sender, end date, window) reads that many rows, and sum, max and min all follow from the blocks.

* shuffle 1: (sender, day) sums, partially aggregated; a hot sender is one row per day and task;
* shuffle 2: (sender, level, block) for the blocks that some window needs (a broadcast list of end dates x windows
  x 2 log2(days) + 2 rows, checked against ``MOST_PIECES``);
* shuffle 3: (sender, end date) with all windows as columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions.dates import in_window, window_list, window_start
from riskbook.operators.book import ID, MEASURES, OWN_BANK, mark_flagged, mark_own_bank

END = "dat_ref_fim"
MOST_PIECES = 2_000_000  # rows of the broadcast list, some 40 bytes each

# Column of a block, and how blocks combine.
_PARTS = {
    "vl_sum": ("sum", "vl_tran"), "qt_sum": ("sum", "qt_tran"), "vl_match_sum": ("sum", "vl_match"), "qt_match_sum": ("sum", "qt_match"),
    "vl_match_max": ("max", "vl_match"), "qt_match_max": ("max", "qt_match"), "vl_match_min": ("min", "vl_match"), "qt_match_min": ("min", "qt_match"),
}


def day_number(day: str) -> int:
    return date.fromisoformat(day).toordinal() - date(1970, 1, 1).toordinal()


def pieces(first: int, last: int) -> list[tuple[int, int]]:
    """(level, block) of the fewest aligned blocks that make up the days first..last."""
    out, level = [], 0
    while first <= last:
        if first & 1:
            out.append((level, first))
            first += 1
        if not last & 1 and first <= last:
            out.append((level, last))
            last -= 1
        first, last, level = first >> 1, last >> 1, level + 1
    return out


def _source(prefix: str, fn: str, conditional: bool) -> str:
    """Block column of a measure of the book."""
    return f"{prefix[:2]}_match_{fn}" if conditional else f"{prefix[:2]}_sum"


def book_as_of(
    financial: DataFrame, flagged_table: DataFrame, end_dates: Sequence[str], days_to_evaluate: int, windows: Sequence[int] | None = None, own_bank: int = OWN_BANK
) -> DataFrame:
    """``dat_ref_fim`` and the columns of :func:`trailing_book`, one row per end date and sender with a transfer in that date's base
    window (``days_to_evaluate`` + 1 days back); equal to a book of each date on its own.

    ``financial`` must reach back to the first date's base window. A null sender has an all-zero row per date with such transfers.
    """
    windows = list(windows or window_list(days_to_evaluate))
    ends = sorted({window_start(d) for d in end_dates})
    spark = financial.sparkSession
    base = days_to_evaluate + 1
    wanted = []
    for end in ends:
        last = day_number(end)
        for w in {*windows, base}:
            wanted += [(level, block, end, w) for level, block in pieces(last - w, last)]
    if len(wanted) > MOST_PIECES:
        raise ValueError(f"{len(ends)} end dates need a list of {len(wanted)} blocks; give fewer at a time")
    needed = spark.createDataFrame(wanted, f"level int, block long, {END} string, window int")
    levels = max(w[0] for w in wanted)

    fin = financial.select(
        F.col("nr_cpf_cnpj_sender").alias(ID), "cd_bank_sender", "nr_cpf_cnpj_receiver", F.col("vl_titulo").alias("vl_tran"), F.col("qtd_titulo").cast("long").alias("qt_tran"), "dat_ref_carga"
    )
    fin = in_window(fin, window_start(ends[0], days=base), ends[-1])
    fin = mark_flagged(mark_own_bank(fin, code=own_bank), flagged_table)
    match = "sant_trans = 1 and bet_trans = 1"
    fin = fin.selectExpr(
        ID, "datediff(to_date(dat_ref_carga), date'1970-01-01') as day", "vl_tran", "qt_tran",
        f"case when {match} then vl_tran else 0D end as vl_match", f"case when {match} then qt_tran else 0L end as qt_match",
    )
    daily = fin.groupBy(ID, "day").agg(*[F.expr(f"{fn}({value})").alias(name) for name, (fn, value) in _PARTS.items()])
    tree = daily.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels)))).withColumn("block", F.expr("shiftright(cast(day as long), level)"))
    tree = tree.join(F.broadcast(needed.select("level", "block").distinct()), ["level", "block"], "left_semi")
    blocks = tree.groupBy(ID, "level", "block").agg(*[F.expr(f"{fn}({name})").alias(name) for name, (fn, _) in _PARTS.items()])
    used = blocks.join(F.broadcast(needed), ["level", "block"])

    aggs, out = [F.max(F.col("window") == base).alias("_in_base")], [END, ID]
    for w in windows:
        for prefix, fn, _, conditional in MEASURES:
            name = f"{prefix}_{w}"
            aggs.append(F.expr(f"{fn}(case when window = {w} then {_source(prefix, fn, conditional)} end)").alias(name))
            if name.startswith("vl"):
                out.append(f"cast(case when {ID} is null then 0D else nanvl(coalesce({name}, 0D), 0D) end as double) as {name}")
            else:
                out.append(f"cast(case when {ID} is null then 0 else coalesce({name}, 0) end as int) as {name}")
    return used.groupBy(END, ID).agg(*aggs).where("_in_base").selectExpr(*out)
