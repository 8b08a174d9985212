"""Edge cases of SURVEY §2.12 (Q1-Q16) on tiny hand-made frames."""

import math

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from riskbook.functions.dates import in_window, window_list, window_start
from riskbook.operators import behavior, book, labels, transfers
from riskbook.session import scratch_path
from riskbook.sources.tables import write_table
from tests import brute_force

RAW_SCHEMA = (
    "nr_cpf_cnpj_sender string, nr_account_sender string, nr_office_sender string, cd_bank_sender string, "
    "nr_cpf_cnpj_receiver string, nr_account_receiver string, nr_office_receiver string, cd_bank_receiver string, "
    "vl_pgto double, dat_ref_carga string"
)
FIN_SCHEMA = (
    "nr_cpf_cnpj_sender string, nr_account_sender int, nr_office_sender int, cd_bank_sender int, "
    "nr_cpf_cnpj_receiver string, nr_account_receiver int, nr_office_receiver int, cd_bank_receiver int, "
    "dat_ref_carga string, vl_titulo double, qtd_titulo int"
)
END = "2024-06-30"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def t(sender="1", receiver="9", amount=10.0, day=END, bank="1", account="100"):
    return (sender, account, "10", bank, receiver, "200", "20", "2", amount, day)


def fin_row(sender, receiver, day, amount, count=1, bank=1):
    return (sender, 100, 10, bank, receiver, 200, 20, 2, day, amount, count)


def flagged(spark, ids):
    return spark.createDataFrame([(i, 1) for i in ids], "nr_cpf_cnpj string, fl_cartola int")


def as_dict(df, key="nr_cpf_cnpj"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_window_list_and_unknown_days():
    assert window_list(180) == [1, 7, 15, 30, 60, 90, 180]
    assert window_list(30) == [1, 7, 15, 30]
    with pytest.raises(ValueError):
        window_list(45)


def test_window_start_month_end_clamp(spark):
    from riskbook.functions.dates import window_start_col

    cases = [("2024-03-31", 0, 1, 0), ("2024-03-31", 0, 1, 1), ("2023-05-31", 1, 3, 0), ("2024-02-29", 0, 0, 1), ("2024-01-01", 181, 0, 0)]
    expected = ["2024-02-29", "2023-02-28", "2023-02-28", "2023-02-28", "2023-07-04"]
    assert [window_start(*c) for c in cases] == expected
    df = spark.createDataFrame([(c[0],) for c in cases], "d string")
    cols = [window_start_col(F.col("d"), *c[1:]).alias(f"c{i}") for i, c in enumerate(cases)]
    row = df.select(*cols).collect()
    assert [row[i][f"c{i}"] for i in range(len(cases))] == expected


def test_q3_inclusive_windows(spark):
    # base window for 1 day: end - 2 .. end (3 dates); book window 1: end - 1 .. end (2 dates)
    rows = [t(day="2024-06-27"), t(day="2024-06-28", amount=1.0), t(day="2024-06-29", amount=2.0), t(day=END, amount=4.0)]
    fin = transfers.financial_features({"PIX": raw(spark, rows)}, END, 1)
    assert sorted(r.dat_ref_carga for r in fin.collect()) == ["2024-06-28", "2024-06-29", END]
    b = book.trailing_book(fin, flagged(spark, []), END, 1).collect()[0]
    assert b.vl_tran_total_sum_1 == 6.0 and b.qt_tran_total_sum_1 == 2


def test_q3_sender_only_on_oldest_date_gets_zero_row(spark):
    fin = transfers.financial_features({"PIX": raw(spark, [t(sender="7", day="2024-06-28")])}, END, 1)
    b = book.trailing_book(fin, flagged(spark, []), END, 1).collect()
    assert len(b) == 1 and b[0].nr_cpf_cnpj == "7" and b[0].vl_tran_total_sum_1 == 0.0


def test_q4_min_is_zero_once_a_non_matching_row_exists(spark):
    fin = spark.createDataFrame(
        [fin_row("1", "F", END, 50.0, bank=1), fin_row("1", "X", END, 30.0, bank=1), fin_row("2", "F", END, 20.0, bank=1)],
        FIN_SCHEMA,
    )
    b = as_dict(book.trailing_book(fin, flagged(spark, ["F"]), END, windows=[1]))
    assert b["1"]["vl_tran_sant_bets_min_1"] == 0.0 and b["1"]["vl_tran_sant_bets_max_1"] == 50.0
    assert b["2"]["vl_tran_sant_bets_min_1"] == 20.0
    assert b["1"]["vl_tran_sant_bets_sum_1"] == 50.0 and b["1"]["vl_tran_total_sum_1"] == 80.0


def test_q7_duplicates_collapse_within_a_channel_only(spark):
    same = [t(), t()]
    fin = transfers.financial_features({"PIX": raw(spark, same), "TED": raw(spark, [t()])}, END, 1)
    rows = fin.collect()
    assert len(rows) == 2 and all(r.vl_titulo == 10.0 and r.qtd_titulo == 1 for r in rows)


def test_q8_duplicate_risk_rows_multiply_campaign_sums(spark):
    camp = spark.createDataFrame([("1", 2, 1, END), ("2", 1, 0, END)], "nr_cpf_cnpj string, camp_disparo int, camp_conversao int, dat_ref_carga string")
    risk = spark.createDataFrame([("1", END, 1), ("1", END, 1), ("3", END, 1)], "nr_cpf_cnpj string, dat_ref_carga string, flag_bloqueio int")
    got = as_dict(behavior.behavioral_features(camp, risk, END, 1))
    assert got["1"]["qtd_camp_disparo"] == 4 and got["1"]["qtd_camp_conversao"] == 2 and got["1"]["flag_bloqueio"] == 1
    assert got["2"]["qtd_camp_disparo"] == 1 and got["2"]["flag_bloqueio"] == 0
    assert got["3"]["qtd_camp_disparo"] == 0 and got["3"]["flag_bloqueio"] == 1
    ref = brute_force.behavior_rows([tuple(r) for r in camp.collect()], [tuple(r) for r in risk.collect()], {END})
    assert {k: tuple(r[c] for c in ("qtd_camp_disparo", "qtd_camp_conversao", "flag_bloqueio")) for k, r in got.items()} == ref


def test_behavioral_null_ids_and_null_flags_match_full_join(spark):
    camp = spark.createDataFrame(
        [(None, 2, 1, END), (None, 3, 0, "2024-06-29"), ("1", None, 1, END), ("4", 5, 5, END)],
        "nr_cpf_cnpj string, camp_disparo int, camp_conversao int, dat_ref_carga string",
    )
    risk = spark.createDataFrame(
        [(None, END, -1), (None, END, 1), ("1", END, None), ("4", END, -3), ("4", END, -2)],
        "nr_cpf_cnpj string, dat_ref_carga string, flag_bloqueio int",
    )
    got = behavior.behavioral_features(camp, risk, END, 1)
    ref = brute_force.behavior_rows([tuple(r) for r in camp.collect()], [tuple(r) for r in risk.collect()], {END, "2024-06-29"})
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == ref


def test_q9_malformed_ints_become_null_not_errors(spark):
    rows = [("1", "12a", "10", "1", "9", "0200", "20", "x", 10.0, END)]
    clean = transfers.clean_transfers(raw(spark, rows), "2024-06-01", END).collect()[0]
    assert clean.nr_account_sender is None and clean.cd_bank_receiver is None and clean.nr_account_receiver == 200


def test_q10_null_sender_keeps_an_all_zero_row(spark):
    fin = spark.createDataFrame([fin_row(None, "F", END, 50.0), fin_row("1", "F", END, 5.0)], FIN_SCHEMA)
    b = as_dict(book.trailing_book(fin, flagged(spark, ["F"]), END, windows=[1, 7]))
    assert set(b) == {None, "1"}
    assert all(v == 0 for k, v in b[None].items() if k != "nr_cpf_cnpj")
    assert b["1"]["vl_tran_sant_bets_sum_7"] == 5.0


def test_q11_null_or_unknown_receiver_and_empty_list(spark):
    fin = spark.createDataFrame([fin_row("1", None, END, 5.0), fin_row("2", "Z", END, 5.0), fin_row("3", "F", END, 5.0)], FIN_SCHEMA)
    cart = spark.createDataFrame([("F", 1), ("F", 1), ("Z", 0), (None, 1)], "nr_cpf_cnpj string, fl_cartola int")
    flags = {r.nr_cpf_cnpj_sender: r.bet_trans for r in book.mark_flagged(fin, cart).collect()}
    assert flags == {"1": 0, "2": 0, "3": 1}
    empty = cart.limit(0)
    assert {r.bet_trans for r in book.mark_flagged(fin, empty).collect()} == {0}
    # a shuffled join gives the same flags
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flags2 = {r.nr_cpf_cnpj_sender: r.bet_trans for r in book.mark_flagged(fin, cart).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert flags2 == flags


def test_q12_count_overflow_fails_loudly(spark):
    big = 2**31 - 1
    fin = spark.createDataFrame([fin_row("1", "F", END, 1.0, count=big), fin_row("1", "G", END, 1.0, count=big)], FIN_SCHEMA)
    with pytest.raises(ArithmeticException):
        book.trailing_book(fin, flagged(spark, []), END, windows=[1]).collect()


def test_q13_nan_amounts_pass_filter_and_fill_to_zero(spark):
    fin = transfers.financial_features({"PIX": raw(spark, [t(amount=float("nan")), t(receiver="8", amount=3.0)])}, END, 1)
    vals = sorted((r.vl_titulo for r in fin.collect()), key=lambda v: (math.isnan(v), v))
    assert vals[0] == 3.0 and math.isnan(vals[1])
    b = book.trailing_book(fin, flagged(spark, []), END, 1).collect()[0]
    assert b.vl_tran_total_sum_1 == 0.0  # NaN sum filled like fillna(0)
    assert b.qt_tran_total_sum_1 == 2


def test_q5_receiver_totals_fan_out_and_dedupe(spark):
    trans = spark.createDataFrame(
        [("a", "J1", 10.0), ("b", "J1", 5.0), ("a", "J2", 7.0), ("a", "F1", 100.0), (None, None, 1.0)],
        "nr_cpf_cnpj_sender string, nr_cpf_cnpj_receiver string, vl_pgto double",
    )
    persons = spark.createDataFrame(
        [("J1", "J"), ("J1", "J"), ("J1", "J"), ("J2", "J"), ("F1", "F")], "nr_cpf_cnpj string, cd_tipo_doc string"
    )
    got = {r[0]: r[1] for r in labels.receiver_totals(trans, persons).collect()}
    assert got == {"J1": 45.0, "J2": 7.0}
    fanned = labels.received_by_type(trans, persons).groupBy("nr_cpf_cnpj_receiver").agg(F.sum("vl_pgto")).collect()
    assert {r[0]: r[1] for r in fanned} == got
    assert {r[0]: r[1] for r in labels.receiver_totals(trans, persons, dedupe_persons=True).collect()} == {"J1": 15.0, "J2": 7.0}


def test_q6_rank_ties_broken_by_id(spark):
    totals = spark.createDataFrame([("c", 5.0), ("b", 5.0), ("a", 5.0), ("d", 9.0)], "nr_cpf_cnpj_receiver string, vl_total_recebido double")
    got = [r.nr_cpf_cnpj for r in labels.rank_band(totals, 2, 4).collect()]
    assert sorted(got) == ["a", "b"]


def test_q16_sample_draws_distinct_ids(spark):
    persons = spark.createDataFrame(
        [(str(i % 50), "F") for i in range(400)] + [("J0", "J")], "nr_cpf_cnpj string, cd_tipo_doc string"
    )
    trans = spark.createDataFrame([("1", "2024-01-0" + str(d)) for d in range(1, 6)], "nr_cpf_cnpj_sender string, dat_ref_carga string")
    s = labels.sample_customers(persons, trans, fraction=0.1, seed=7).collect()
    assert len(s) == 5 and len({r[0] for r in s}) == 5
    assert all(r[1].startswith("2024-01-0") for r in s)
    s2 = labels.sample_customers(persons, trans, fraction=0.1, seed=7).collect()
    assert sorted(s) == sorted(s2)
    assert len(labels.sample_customers(persons, trans, fraction=0.0001, seed=7).collect()) == 1


def test_tax_id_rules(spark):
    from riskbook.functions.taxid import is_valid_tax_id

    rows = [
        ("52998224725", "F", 1),  # valid person id
        ("52998224724", "F", 0),
        ("11444777000161", "J", 1),  # valid company id
        ("11444777000162", "J", 0),
        ("5299822472", "F", 0),
        ("5299822472a", "F", 0),
        ("52998224725", "J", 0),
        ("52998224725", None, 0),
        (None, "F", 0),
    ]
    df = spark.createDataFrame(rows, "id string, tp string, expected int")
    got = df.select(is_valid_tax_id("id", "tp").alias("v"), "expected").collect()
    assert [r.v for r in got] == [r.expected for r in got]


def test_times_of_day_stay_in_their_day(spark):
    rows = [("1", "2024-06-28 23:59:59"), ("1", "2024-06-30 10:00:00"), ("1", "2024-07-01 00:00:00"), ("1", None)]
    text = spark.createDataFrame(rows, "k string, dat_ref_carga string")
    for kind in ("timestamp", "timestamp_ntz", "date"):
        got = in_window(text.withColumn("dat_ref_carga", F.col("dat_ref_carga").cast(kind)), "2024-06-28", "2024-06-30").collect()
        assert sorted(r.dat_ref_carga for r in got) == ["2024-06-28", "2024-06-30"]
    odd = spark.createDataFrame([("2024-06-29",), ("2024-06-29 10:00",), ("29/06/2024",), ("2024-06-3",), (None,)], "dat_ref_carga string")
    assert [r[0] for r in in_window(odd, "2024-06-28", "2024-06-30").collect()] == ["2024-06-29"]


def test_partitioned_tables_keep_types_values_and_order(spark):
    df = spark.createDataFrame([("2024-01-01", "001", 1, 2.5), ("2024-01-02", "002", 2, None), ("2024-01-02", None, 3, 1.0)], "day string, code string, n int, v double")
    back = write_table(df, scratch_path(spark, "parts"), partition_by=["code", "day"])
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_aqe_splits_a_hot_key(spark):
    """AQE splits the partition of a hot key (tiny thresholds, so that the small
    test data counts as skewed)."""
    import contextlib
    import io

    from riskbook.functions.joins import join_on

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
        big = spark.range(200000).select(key.alias("k"), "id")
        small = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("sk"))
        small = small.union(spark.createDataFrame([("hot",)], "sk string")).distinct()
        df = join_on(big, small, "k", "sk", "left")
        assert df.count() == 200000
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_q1_windows_filter_on_the_transfer_date(spark):
    """The reference filters on a date column it has just dropped (resolved
    by the analyzer); here the date stays until the aggregate. A transfer is
    counted in exactly the windows that contain its date."""
    fin = spark.createDataFrame(
        [fin_row("1", "F", END, 1.0), fin_row("1", "F", "2024-06-24", 10.0), fin_row("1", "F", "2024-06-16", 100.0)],
        FIN_SCHEMA,
    )
    b = book.trailing_book(fin, flagged(spark, ["F"]), END, windows=[1, 7, 15]).collect()[0]
    assert (b.vl_tran_total_sum_1, b.vl_tran_total_sum_7, b.vl_tran_total_sum_15) == (1.0, 11.0, 111.0)


def test_q14_customers_without_campaign_or_risk_rows_drop_out(spark):
    from riskbook.operators.master import master_table

    fin = spark.createDataFrame([fin_row("1", "F", END, 1.0), fin_row("2", "F", END, 2.0)], FIN_SCHEMA)
    bk = book.trailing_book(fin, flagged(spark, ["F"]), END, windows=[1])
    camp = spark.createDataFrame([("1", 1, 0, END)], "nr_cpf_cnpj string, camp_disparo int, camp_conversao int, dat_ref_carga string")
    risk = spark.createDataFrame([], "nr_cpf_cnpj string, dat_ref_carga string, flag_bloqueio int")
    m = master_table(behavior.behavioral_features(camp, risk, END, 1), bk).collect()
    assert [r.nr_cpf_cnpj for r in m] == ["1"] and m[0].flag_bloqueio == 0


def test_channel_sink_reads_back_one_partition(spark):
    import contextlib
    import io

    from riskbook.session import scratch_path

    df = spark.createDataFrame([(*t(), "PIX"), (*t(receiver="8"), "TED")], RAW_SCHEMA + ", tp_transacao string")
    table = transfers.write_channels(df, "tp_transacao", scratch_path(spark, "channels"))
    one = table.filter(F.col("tp_transacao") == "TED")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain()
    assert "PartitionFilters: [isnotnull(tp_transacao" in buf.getvalue() and "= TED" in buf.getvalue()
    assert [r.nr_cpf_cnpj_receiver for r in one.collect()] == ["8"]
    split = transfers.split_channels(df, "tp_transacao", ["PIX", "TED", "DOC"])
    assert [split[c].count() for c in ("PIX", "TED", "DOC")] == [1, 1, 0] and "tp_transacao" not in split["PIX"].columns


def test_malformed_dates_become_null_not_errors(spark):
    from riskbook.functions.dates import window_start_col
    from riskbook.operators.metrics import needs_retrain

    df = spark.createDataFrame([("2024-06-30",), ("30/06/2024",), (None,)], "d string")
    got = [r.s for r in df.select(window_start_col(F.col("d"), 1, 1).alias("s")).collect()]
    assert got == ["2024-05-29", None, None]
    daily = spark.createDataFrame([("2024-06-29", 0.9), ("2024-06-30", 0.5), ("bad", 0.7)], "dat_ref_carga string, roc_auc double")
    gate = {r.dat_ref_carga: r.fl_retreinar for r in needs_retrain(daily, 0.85).collect()}
    assert gate["2024-06-30"] == 0 and gate["2024-06-29"] == 1 and gate["bad"] == 1
