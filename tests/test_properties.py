"""Properties: the plans equal plain definitions of what they compute."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskbook.functions.dates import window_start
from riskbook.functions.ranking import exact_rank, smallest_by_hash
from riskbook.operators import behavior, book, labels, metrics, transfers
from riskbook.sources import fixtures as fx
from tests import brute_force
from tests.conftest import SF_SMALL


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_fused_financial_equals_per_feed_union(spark):
    feeds = fx.raw_channels(spark, SF_SMALL)
    fused = transfers.financial_features(feeds, fx.END_DATE, fx.DAYS_TO_EVALUATE)
    start = window_start(fx.END_DATE, days=fx.DAYS_TO_EVALUATE + 1)
    parts = [transfers.daily_pairs(transfers.clean_transfers(df, start, fx.END_DATE)) for df in feeds.values()]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert fused.columns == union.columns
    assert rows_of(fused) == rows_of(union)
    tagged = transfers.financial_features(
        fx.fixture(spark, SF_SMALL, "transfers_raw"), fx.END_DATE, fx.DAYS_TO_EVALUATE, channel_col="tp_transacao"
    )
    assert rows_of(tagged) == rows_of(union)


def same_book(fin, flagged, end, windows, got):
    rows = [
        {"sender": r.nr_cpf_cnpj_sender, "bank": r.cd_bank_sender, "receiver": r.nr_cpf_cnpj_receiver, "day": r.dat_ref_carga, "amount": r.vl_titulo, "count": r.qtd_titulo}
        for r in fin.collect()
    ]
    expected = brute_force.book_rows(rows, {r[0] for r in flagged.collect() if r[1] == 1}, end, windows)
    assert [(f.name, f.dataType.typeName()) for f in got.schema][1:] == [
        (f"{p}_tran_{m}_{w}", "double" if p == "vl" else "integer")
        for w in windows
        for m in ("total_sum", "sant_bets_sum", "sant_bets_max", "sant_bets_min")
        for p in ("vl", "qt")
    ]
    found = got.collect()
    assert len(found) == len(expected)
    for r in found:
        assert r.asDict() == expected[r.nr_cpf_cnpj]


def test_book_of_the_table(spark):
    fin = transfers.financial_features(fx.raw_channels(spark, SF_SMALL), fx.END_DATE, fx.DAYS_TO_EVALUATE)
    cart = fx.fixture(spark, SF_SMALL, "flagged_table")
    same_book(fin, cart, fx.END_DATE, [1, 7, 15, 30, 60, 90, 180], book.trailing_book(fin, cart, fx.END_DATE, fx.DAYS_TO_EVALUATE))


def test_book_rows_are_distinct_senders_and_windows_grow(spark):
    fin = transfers.financial_features(fx.raw_channels(spark, SF_SMALL), fx.END_DATE, fx.DAYS_TO_EVALUATE)
    b = book.trailing_book(fin, fx.fixture(spark, SF_SMALL, "flagged_table"), fx.END_DATE, fx.DAYS_TO_EVALUATE)
    assert b.count() == fin.select("nr_cpf_cnpj_sender").distinct().count()
    ws = [1, 7, 15, 30, 60, 90, 180]
    for r in b.collect():
        sums = [r[f"vl_tran_total_sum_{w}"] for w in ws]
        counts = [r[f"qt_tran_total_sum_{w}"] for w in ws]
        assert sums == sorted(sums) and counts == sorted(counts)


def same_behavior(camp, risk, end, n_days):
    got = behavior.behavioral_features(camp, risk, end, n_days)
    assert [(f.name, f.dataType.typeName()) for f in got.schema] == [
        ("nr_cpf_cnpj", "string"), ("qtd_camp_disparo", "long"), ("qtd_camp_conversao", "long"), ("flag_bloqueio", "integer")
    ]
    first = window_start(end, days=n_days + 1)
    days = {r[0] for df in (camp, risk) for r in df.select("dat_ref_carga").collect() if first <= r[0] <= end}
    order = ("nr_cpf_cnpj", "camp_disparo", "camp_conversao", "dat_ref_carga")
    expected = brute_force.behavior_rows([tuple(r) for r in camp.select(*order).collect()], [tuple(r) for r in risk.select("nr_cpf_cnpj", "dat_ref_carga", "flag_bloqueio").collect()], days)
    rows = got.collect()
    assert len(rows) == len(expected) and {r[0]: tuple(r[1:]) for r in rows} == expected


def test_behavior_of_the_table(spark):
    camp, risk = fx.fixture(spark, SF_SMALL, "raw_campanhas"), fx.fixture(spark, SF_SMALL, "raw_riscos")
    same_behavior(camp, risk.unionByName(risk.limit(3)), fx.END_DATE, fx.DAYS_TO_EVALUATE)  # duplicate risk rows (Q8)


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    u = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return u / (len(pos) * len(neg))


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.5001, 0.9, 1.0, 1.5, -0.2]), st.integers(0, 1)),
        min_size=1,
        max_size=40,
    )
)
def test_auc_equals_pairwise_count(spark, rows):
    df = spark.createDataFrame(rows, "g int, score double, label int")
    got = {r.g: r.roc_auc for r in metrics.roc_auc(df, group_cols=["g"]).collect()}
    for g in {r[0] for r in rows}:
        want = brute_auc([(s, y) for gg, s, y in rows if gg == g])
        if want is None:
            assert got[g] is None
        else:
            assert got[g] == pytest.approx(want, abs=1e-12)


def test_auc_equals_spark_evaluator(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "score double, label int")
    ours = metrics.roc_auc(df).collect()[0].roc_auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    theirs = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_auc_of_margins_nan_nulls_and_odd_labels(spark):
    rows = [(-2000.0, 0), (1500.0, 1), (float("nan"), 0), (3.0, 1), (3.0, 0), (None, 1), (0.5, 2), (0.5, None), (float("inf"), 1)]
    got = metrics.roc_auc(spark.createDataFrame(rows, "score double, label int")).collect()
    assert len(got) == 1 and (got[0].n_pos, got[0].n_neg, got[0].n_unusable) == (3, 3, 3)
    # NaN above everything: of 9 pairs 2.5 (1500) + 1.5 (3.0, one tie) + 2 (inf) are right.
    above = [(1500.0, 2), (3.0, 1.5), (float("inf"), 2)]
    assert got[0].roc_auc == pytest.approx(sum(x for _, x in above) / 9)
    only = metrics.roc_auc(spark.createDataFrame([(None, 1)], "score double, label int")).collect()[0]
    assert (only.n_pos, only.n_neg, only.n_unusable, only.roc_auc) == (0, 0, 1, None)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_exact_rank_over_ranges(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rng = random.Random(8)
        rows = [(f"k{i}", float(rng.randint(0, 40))) for i in range(3000)]
        df = spark.createDataFrame(rows, "k string, v double")
        got = {r.k: (r._rank, r._rows) for r in exact_rank(df, F.desc("v"), "k").collect()}
        band = labels.rank_band(df, 1500, 1600, "k", "v").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    order = [k for k, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert got == {k: (i + 1, 3000) for i, k in enumerate(order)}
    assert sorted(r[0] for r in band) == sorted(order[1499:1599])


@pytest.mark.parametrize("n", [1, 7, 150, 999])
def test_smallest_by_hash_equals_sort_and_limit(spark, n):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    got = smallest_by_hash(ids, "k", 42, n=n, prefix_digits=2)
    want = ids.orderBy(F.md5(F.concat("k", F.lit(":42"))), "k").limit(n)
    assert sorted(r.k for r in got.collect()) == sorted(r.k for r in want.collect())
    ranks = sorted(r._rank for r in got.collect())
    assert ranks == list(range(1, n + 1))
    by_fraction = smallest_by_hash(ids, "k", 42, fraction=n / 1000 + 1e-9, prefix_digits=2)
    assert sorted(r.k for r in by_fraction.collect()) == sorted(r.k for r in got.collect())


def test_folds_are_balanced_and_stable(spark):
    ids = spark.range(3000).select(F.col("id").cast("string").alias("nr_cpf_cnpj"))
    f1 = metrics.assign_fold(ids, "nr_cpf_cnpj", 3, 42)
    counts = {r.fold: r["count"] for r in f1.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and min(counts.values()) > 900
    assert rows_of(f1) == rows_of(metrics.assign_fold(ids, "nr_cpf_cnpj", 3, 42))


DAYS = ["2024-06-26", "2024-06-27", "2024-06-28", "2024-06-29", "2024-06-30", "2024-07-01"]
IDS = st.sampled_from(["1", "2", "3", None])


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(IDS, st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 2), st.sampled_from(DAYS)), max_size=12),
    st.lists(st.tuples(IDS, st.sampled_from(DAYS), st.one_of(st.none(), st.integers(-2, 2))), max_size=10),
)
def test_behavior_of_random_rows(spark, camp_rows, risk_rows):
    camp = spark.createDataFrame(camp_rows, "nr_cpf_cnpj string, camp_disparo int, camp_conversao int, dat_ref_carga string")
    risk = spark.createDataFrame(risk_rows, "nr_cpf_cnpj string, dat_ref_carga string, flag_bloqueio int")
    same_behavior(camp, risk, "2024-06-30", 2)


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            IDS,
            st.integers(1, 2),
            st.sampled_from(["F", "G", None]),
            st.sampled_from(DAYS),
            st.sampled_from([1.0, 2.5, 7.0, float("nan")]),
            st.integers(1, 3),
        ),
        min_size=1,
        max_size=15,
    )
)
def test_book_of_random_rows(spark, rows):
    fin = spark.createDataFrame(
        [(s, 100, 10, bank, r, 200, 20, 2, d, v, q) for s, bank, r, d, v, q in rows],
        "nr_cpf_cnpj_sender string, nr_account_sender int, nr_office_sender int, cd_bank_sender int, "
        "nr_cpf_cnpj_receiver string, nr_account_receiver int, nr_office_receiver int, cd_bank_receiver int, "
        "dat_ref_carga string, vl_titulo double, qtd_titulo int",
    )
    cart = spark.createDataFrame([("F", 1), ("G", 0)], "nr_cpf_cnpj string, fl_cartola int")
    same_book(fin, cart, "2024-06-30", [1, 7], book.trailing_book(fin, cart, "2024-06-30", 7))
