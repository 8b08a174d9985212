"""Replaced tables, tables made once, the full outer join on hot keys, and mergeable AUC states."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskbook.functions import outer
from riskbook.operators.auc_state import auc_of, auc_state, merged
from riskbook.operators.metrics import roc_auc
from riskbook.session import scratch_path
from riskbook.sources import versions
from riskbook.sources.versions import ConcurrentReplace, current_table, read_or_create, replace_table


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_failing_write_leaves_the_old_table(spark):
    path = scratch_path(spark, "t")
    with pytest.raises(FileNotFoundError):
        current_table(spark, path)
    first = spark.range(10).withColumn("p", F.col("id") % 3)
    replace_table(first, path, partition_by=["p"])
    reader = current_table(spark, path)
    broken = spark.range(10).withColumn("p", F.when(F.col("id") == 7, F.raise_error(F.lit("lost")).cast("long")).otherwise(0))
    with pytest.raises(PySparkException):
        replace_table(broken, path)
    assert rows_of(current_table(spark, path).select("id", "p")) == rows_of(first)
    second = replace_table(current_table(spark, path).where("id < 5"), path)
    assert second.count() == 5 == current_table(spark, path).count()
    assert reader.count() == 10  # the version before is kept for who still reads it


def test_only_the_last_versions_stay(spark):
    path = scratch_path(spark, "t")
    for n in range(5):
        replace_table(spark.range(n + 1), path, keep=2)
    fs, at = versions._fs(spark, f"{path}/{versions.VERSIONS}")
    assert len(fs.listStatus(at)) == 2 and current_table(spark, path).count() == 5


def test_of_two_writers_one_is_told(spark, monkeypatch):
    path = scratch_path(spark, "t")
    replace_table(spark.range(1), path)
    commits = versions._commits
    stale = commits(spark, path)
    replace_table(spark.range(2), path)
    monkeypatch.setattr(versions, "_commits", lambda *a: stale)
    with pytest.raises(ConcurrentReplace):
        replace_table(spark.range(3), path)
    monkeypatch.undo()
    assert current_table(spark, path).count() == 2


def test_equal_work_runs_no_job_and_half_work_is_done_again(spark):
    base, path = scratch_path(spark, "in"), scratch_path(spark, "made")
    spark.range(100).write.parquet(base)
    work = lambda n: spark.read.parquet(base).where(F.col("id") < n).groupBy((F.col("id") % 7).alias("k")).count()
    first = rows_of(read_or_create(work(50), path))
    df = work(50)
    spark.sparkContext.setJobGroup("again", "again")
    again = read_or_create(df, path)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("again")
    spark.sparkContext.setJobGroup("rest", "rest")
    assert rows_of(again) == first == rows_of(work(50))
    assert rows_of(read_or_create(work(60), path)) == rows_of(work(60)) != first
    assert versions.fingerprint(work(50), "a") != versions.fingerprint(work(50), "b")
    # A folder without the marker was cut off.
    cut = f"{path}/{versions.fingerprint(work(50))}"
    fs, marker = versions._fs(spark, f"{cut}/_SUCCESS")
    fs.delete(marker, False)
    assert rows_of(read_or_create(work(50), path)) == first
    # New input files, new table.
    spark.range(100, 110).write.mode("append").parquet(base)
    assert rows_of(read_or_create(work(500), path)) == rows_of(work(500))


@pytest.mark.parametrize("seed,share", [(1, 0.02), (2, 0.3), (3, 2.0)])
def test_full_outer_equals_spark(spark, seed, share):
    rng = random.Random(seed)
    side = lambda n: [(rng.choice([None, 1, 1, 1, rng.randrange(2, 40)]), rng.choice([None, "x", "y"]), rng.randrange(3)) for _ in range(n)]
    left = spark.createDataFrame(side(300), "a long, b string, v int").repartition(3)
    right = spark.createDataFrame(side(60) + [(99, "x", 1)] * 3, "c long, d string, w int")
    for lk, rk in ((["a"], ["c"]), (["a", "b"], ["c", "d"])):
        plain = left.join(right, [left[x] == right[y] for x, y in zip(lk, rk, strict=True)], "full_outer")
        got = outer.full_outer(left, right, lk, rk, share=share, salts=4)
        assert got.columns == plain.columns and rows_of(got) == rows_of(plain)
    assert rows_of(outer.full_outer(left.limit(0), right, ["a"], ["c"])) == rows_of(right.selectExpr("cast(null as long) a", "cast(null as string) b", "cast(null as int) v", "*"))


def test_hot_keys_are_found(spark):
    left = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") + 10))
    assert len(outer.hot_buckets([(left, ["k"])])) == 1
    assert outer.hot_buckets([(left.where("k <> 5"), ["k"])]) == []


@pytest.mark.parametrize("per_octave", [2, 1024])
def test_auc_states_merge_within_their_bound(spark, per_octave):
    rng = random.Random(per_octave)
    rows = [(f"d{i % 9}", rng.choice([rng.gauss(0, 1), 0.5, float("inf"), float("nan"), None]), rng.choice([0, 0, 1, None, 3])) for i in range(2000)]
    scored = spark.createDataFrame(rows, "day string, score double, label int")
    exact = roc_auc(scored).first()
    days = auc_state(scored, group_cols=["day"], per_octave=per_octave)
    one, whole = auc_of(merged(days)).first(), auc_of(auc_state(scored, per_octave=per_octave)).first()
    assert one == whole and (one.n_pos, one.n_neg) == (exact.n_pos, exact.n_neg)
    assert abs(one.roc_auc - exact.roc_auc) <= one.error + 1e-12
    exact_days = {r.day: r.roc_auc for r in roc_auc(scored, group_cols=["day"]).collect()}
    assert all(abs(r.roc_auc - exact_days[r.day]) <= r.error + 1e-12 for r in auc_of(days, ["day"]).collect())
    empty = auc_of(auc_state(scored.where("label = 1"))).first()
    assert empty.roc_auc is None and empty.n_neg == 0
