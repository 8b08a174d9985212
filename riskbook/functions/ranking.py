"""Deterministic hashing and exact global ranks without a single-task sort.

:func:`exact_rank` ranks by any columns: rows go to ranges, are numbered inside
them, and the ranges' counts (one row per range) give the offsets.
:func:`smallest_by_hash` needs no sorted ranges:

``row_number()`` over an unpartitioned window moves every row into one
task. When the ranked keys are uniform hashes, the same exact rank can be
computed distributedly: bucket by a hash prefix, count the buckets (a
histogram of at most ``16 ** prefix_digits`` rows), turn the counts into
offsets, and rank inside each bucket. Each bucket holds about
``rows / 16 ** prefix_digits`` rows whatever the data, so no task grows with
the input, and only buckets that can hold a wanted rank are ranked at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.session import scratch_path


def hash_hex(*parts: Column | str) -> Column:
    """md5 hex digest of the parts joined by ':' (same text as SQL ``md5``)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(":"))
        cols.append(F.col(p) if isinstance(p, str) else p)
    return F.md5(F.concat(*cols))


def hash_int(hex_col: Column, digits: int = 8) -> Column:
    """Non-negative bigint from the first ``digits`` hex digits (≤ 15)."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("bigint")


def smallest_by_hash(
    df: DataFrame,
    id_col: str,
    seed: int | str,
    n: int | None = None,
    fraction: float | None = None,
    minimum: int = 1,
    prefix_digits: int = 4,
) -> DataFrame:
    """The rows of ``df`` (distinct ids) with the smallest ``md5(id:seed)``,
    ties by id, plus their exact rank ``_rank`` (1-based). Either ``n`` rows,
    or ``max(minimum, floor(total * fraction))`` rows.

    One plan, no driver round trip: a histogram of hash-prefix buckets
    (at most ``16 ** prefix_digits`` rows), its running offsets and the
    total come from a window over that histogram (bounded by its size, not
    by the data), the offsets of the buckets that can hold a wanted rank
    are broadcast back (same bound), and ranks are ``row_number`` per bucket.
    """
    if (n is None) == (fraction is None):
        raise ValueError("give exactly one of n and fraction")
    h = hash_hex(id_col, F.lit(str(seed)))
    # Null ids have no hash and are not ranked. The not-null filter sits in
    # the frame both branches share: the join below would otherwise make
    # Catalyst infer it and push it into the ranking branch only, and the two
    # branches could not reuse one shuffle of ``df`` (it would run twice).
    keyed = (
        df.withColumn("_h", h)
        .withColumn("_b", hash_int(F.col("_h"), prefix_digits).cast("int"))
        .filter(F.col("_b").isNotNull())
    )
    hist = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if n is not None:
        want = F.lit(int(n)).cast("bigint")
    else:
        want = F.greatest(F.lit(int(minimum)), F.floor(F.sum("_cnt").over(everything) * F.lit(float(fraction)))).cast("bigint")
    offsets = (
        hist.select("_b", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"), want.alias("_n"))
        .filter(F.col("_off") < F.col("_n"))
    )
    w = Window.partitionBy("_b").orderBy("_h", id_col)
    ranked = keyed.join(F.broadcast(offsets), "_b").withColumn("_rank", F.col("_off") + F.row_number().over(w))
    return ranked.filter(F.col("_rank") <= F.col("_n")).drop("_h", "_b", "_off", "_n")


# monotonically_increasing_id: the partition above, the row within it below this bit.
_ROW_BITS = 33


def in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` sorted by ``order`` over range partitions, with ``_part`` (number of
    the range, rising with the order) and ``_at`` (place within it, from 0).

    Written to the shared folder and read back: the ranges come from a sample, so
    two evaluations could draw different ones, while the written rows are fixed.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "ranges")
    placed.write.parquet(path)
    placed = df.sparkSession.read.schema(placed.schema).parquet(path)
    at = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.withColumns({"_part": F.shiftright("_id", _ROW_BITS), "_at": at}).drop("_id")


def exact_rank(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` with ``_rank`` (1-based place in ``order``, which must tell all rows apart for
    a defined result) and ``_rows`` (number of rows). No task holds more than one range; the window runs over one row per
    range."""
    placed = in_ranges(df, *order)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part")
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(w) - F.col("_n")).alias("_off"),
        F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_rows"),
    )
    return placed.join(offsets, "_part").withColumn("_rank", F.col("_off") + F.col("_at") + 1).drop("_part", "_at", "_off")
