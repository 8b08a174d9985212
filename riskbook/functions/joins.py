"""Equi-joins against a side that is usually small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str) -> DataFrame:
    """``big[big_key] = small[small_key]``; ``small_key`` is dropped unless the
    join keeps only the big side.

    One lazy plan at every size: no row is counted and nothing is forced. AQE
    broadcasts the small side when its measured bytes allow it, and otherwise
    splits the partitions of hot keys (``spark.sql.adaptive.skewJoin``, which
    ``session.configure`` turns on), so a key holding a third of the big side is
    read by many tasks.
    """
    # AQE splits only partitions that the join itself asked to shuffle. A side that
    # comes hash-partitioned from a distinct would not be shuffled again; a computed (string) key is.
    small = small.withColumn(small_key, F.concat(F.col(small_key), F.lit("")))
    out = big.join(small, F.col(big_key) == F.col(small_key), how)
    return out if how in ("left_semi", "left_anti") else out.drop(small_key)
