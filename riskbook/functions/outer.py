"""FULL OUTER join that a hot key does not stop.

Spark cannot split a skewed partition of a full outer join: unmatched rows of both sides must be seen once. Here the
join is split by key instead. A frequency sketch (rows per hash bucket of the key, partially aggregated,
``SKETCH`` numbers at most) finds the buckets that hold more than a task's share. Keys outside them join as usual. For the keys in
them, equal rows are first collapsed to one with a count, the pairs come from an inner join on key and salt, and what
has no partner from anti-joins with the other side's distinct keys. Null keys match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH = 1 << 14
SALTS = 16
HOT_SHARE = 0.02


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SKETCH)).cast("int")


def hot_buckets(sides: Sequence[tuple[DataFrame, Sequence[str]]], share: float = HOT_SHARE) -> list[int]:
    """Buckets that hold at least ``share`` of the keyed rows of some side: 1 / share numbers a side at most."""
    found: set[int] = set()
    for df, keys in sides:
        keyed = df.where(" and ".join(f"`{k}` is not null" for k in keys))
        counts = keyed.groupBy(_bucket(keys).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        total = counts.agg(F.sum("n")).first()[0]
        if total:
            found |= {r["bucket"] for r in counts.where(F.col("n") >= share * total).collect()}
    return sorted(found)


def full_outer(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], share: float = HOT_SHARE, salts: int = SALTS) -> DataFrame:
    """All columns of left and right, which must not share names; ``left_keys[i] = right_keys[i]`` joins."""
    if set(left.columns) & set(right.columns):
        raise ValueError("left and right share column names")
    on = lambda a, b: [a[x] == b[y] for x, y in zip(left_keys, right_keys, strict=True)]
    columns = [*left.columns, *right.columns]
    hot = hot_buckets([(left, left_keys), (right, right_keys)], share)
    if not hot:
        return left.join(right, on(left, right), "full_outer").select(*columns)
    # A row with a null key has no bucket here: it is never hot.
    is_hot = lambda keys: F.coalesce(_bucket(keys).isin(hot) & F.expr(" and ".join(f"`{k}` is not null" for k in keys)), F.lit(False))
    cold_left, cold_right = left.where(~is_hot(left_keys)), right.where(~is_hot(right_keys))
    cold = cold_left.join(cold_right, on(cold_left, cold_right), "full_outer").select(*columns)
    # Equal rows become one with its count, so a salt by the row's hash spreads whatever is left of a key.
    a = left.where(is_hot(left_keys)).groupBy(*left.columns).agg(F.count(F.lit(1)).alias("_n"))
    b = right.where(is_hot(right_keys)).groupBy(*right.columns).agg(F.count(F.lit(1)).alias("_m"))
    salted = a.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)))
    copied = b.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    pairs = salted.join(copied, [*on(salted, copied), F.col("_salt") == F.col("_copy")])
    pairs = pairs.withColumn("_times", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n") * F.col("_m")))).select(*columns)

    def alone(rows: DataFrame, times: str, keys: Sequence[str], other: DataFrame, other_keys: Sequence[str], missing: DataFrame) -> DataFrame:
        partners = other.select(*other_keys).distinct()
        rest = rows.join(partners, [rows[x] == partners[y] for x, y in zip(keys, other_keys, strict=True)], "left_anti")
        rest = rest.withColumn("_times", F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
        return rest.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(missing.schema[c].dataType).alias(c) for c in columns])

    return cold.unionByName(pairs).unionByName(alone(a, "_n", left_keys, b, right_keys, right)).unionByName(alone(b, "_m", right_keys, a, left_keys, left))
