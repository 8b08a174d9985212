"""Features kept up batch by batch against one run over everything."""

import random

import pytest

from riskbook.operators.transfers import KEY_TYPES, financial_features
from riskbook.plans import incremental
from riskbook.session import scratch_path

RAW = ", ".join(f"{n} string" for n, _ in KEY_TYPES) + ", vl_pgto double, dat_ref_carga string, tp_transacao string"


def transfers(n=300, seed=1):
    rng = random.Random(seed)
    rows = [
        (*[rng.choice(["1", "2", None, "bad"]) for _ in KEY_TYPES], rng.choice([5.0, 7.5, 0.0, float("nan"), None]), rng.choice(["2024-01-01", "2024-01-02", "2024-01-05", None, "x"]), rng.choice(["PIX", "TED"]))
        for _ in range(n)
    ]
    return rows + rows[: n // 3]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_batches_with_replays_and_late_rows_equal_one_run(spark, monkeypatch):
    rows = transfers()
    frame = lambda part: spark.createDataFrame(part, RAW)
    whole = rows_of(financial_features(frame(rows), "2024-01-05", 10, channel_col="tp_transacao"))
    state = scratch_path(spark, "state")
    assert incremental.financial_as_of(spark, state, "2024-01-05", 10).count() == 0
    incremental.add_batch(frame(rows[:150]), state, "one")
    write = incremental.daily_pairs
    monkeypatch.setattr(incremental, "daily_pairs", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        incremental.add_batch(frame(rows[100:250]), state, "two")
    monkeypatch.setattr(incremental, "daily_pairs", write)
    assert incremental.committed(spark, state) == ["one"]
    # The rows of the batch that was cut off do not count as seen.
    incremental.add_batch(frame(rows[200:]), state, "three")
    incremental.add_batch(frame(rows[100:250]), state, "two")
    assert rows_of(incremental.financial_as_of(spark, state, "2024-01-05", 10)) == whole
    assert incremental.add_batch(frame(rows), state, "four") == 0
    incremental.add_batch(frame(rows[:150]), state, "one")
    assert rows_of(incremental.financial_as_of(spark, state, "2024-01-05", 10)) == whole
    early = rows_of(financial_features(frame(rows), "2024-01-02", 0, channel_col="tp_transacao"))
    assert rows_of(incremental.financial_as_of(spark, state, "2024-01-02", 0)) == early
    with pytest.raises(ValueError):
        incremental.add_batch(frame(rows), state, "a/b")


def test_a_batch_is_shuffled_once_for_its_rows_and_once_for_its_pairs(spark, monkeypatch):
    state, plans, write = scratch_path(spark, "state"), [], incremental._write

    def seen(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path)

    rows = transfers()
    incremental.add_batch(spark.createDataFrame(rows[:150], RAW), state, "one")
    monkeypatch.setattr(incremental, "_write", seen)
    incremental.add_batch(spark.createDataFrame(rows[100:], RAW), state, "two")
    assert len(plans) == 2
    assert all(p.count("Exchange ") == 1 for p in plans), plans
