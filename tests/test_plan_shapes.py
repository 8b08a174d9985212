"""Plan-shape invariants: the shuffle counts the scale design relies on.

Broadcasts are switched off here so that every exchange is visible and the
counts do not depend on input sizes.
"""

import contextlib
import io
import re

import pytest

from riskbook.operators import behavior, book, labels, master, metrics, transfers
from riskbook.sources import fixtures as fx


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", text))


RAW = (
    "nr_cpf_cnpj_sender string, nr_account_sender string, nr_office_sender string, cd_bank_sender string, "
    "nr_cpf_cnpj_receiver string, nr_account_receiver string, nr_office_receiver string, cd_bank_receiver string, "
    "vl_pgto double, dat_ref_carga string"
)


def test_financial_features_two_shuffles_for_any_number_of_feeds(no_broadcast):
    spark = no_broadcast
    row = ("1", "100", "10", "1", "9", "200", "20", "2", 10.0, fx.END_DATE)
    feeds = {c: spark.createDataFrame([row], RAW) for c in ("PIX", "TED", "DOC", "BOLETO")}
    for n in (1, 3, 4):
        p = plan(transfers.financial_features(dict(list(feeds.items())[:n]), fx.END_DATE, fx.DAYS_TO_EVALUATE))
        assert shuffles(p) == 2
    tagged = spark.createDataFrame([(*row, "PIX"), (*row, "TED")], RAW + ", tp_transacao string")
    p = plan(transfers.financial_features(tagged, fx.END_DATE, fx.DAYS_TO_EVALUATE, channel_col="tp_transacao"))
    assert shuffles(p) == 2


def test_book_is_one_aggregate_and_master_join_adds_no_shuffle(no_broadcast):
    spark = no_broadcast
    fin = spark.createDataFrame(
        [("1", 100, 10, 1, "F", 200, 20, 2, fx.END_DATE, 5.0, 1)],
        "nr_cpf_cnpj_sender string, nr_account_sender int, nr_office_sender int, cd_bank_sender int, "
        "nr_cpf_cnpj_receiver string, nr_account_receiver int, nr_office_receiver int, cd_bank_receiver int, "
        "dat_ref_carga string, vl_titulo double, qtd_titulo int",
    )
    flagged = spark.createDataFrame([("F", 1)], "nr_cpf_cnpj string, fl_cartola int")
    camp = spark.createDataFrame([("1", 1, 0, fx.END_DATE)], "nr_cpf_cnpj string, camp_disparo int, camp_conversao int, dat_ref_carga string")
    risk = spark.createDataFrame([("1", fx.END_DATE, 1)], "nr_cpf_cnpj string, dat_ref_carga string, flag_bloqueio int")
    bk = book.trailing_book(fin, flagged, fx.END_DATE, fx.DAYS_TO_EVALUATE)
    beh = behavior.behavioral_features(camp, risk, fx.END_DATE, fx.DAYS_TO_EVALUATE)
    p_book, p_beh = plan(bk), plan(beh)
    # book: distinct flagged ids (1), both sides of the flagged join (2), the one
    # groupBy(sender); where the list may be broadcast the join's shuffles go.
    assert shuffles(p_book) == 4 and p_book.count("SortMergeJoin") == 1
    # behaviour: partial agg per (customer, day) + per customer, no join
    assert shuffles(p_beh) == 2 and "Join" not in p_beh
    p_master = plan(master.master_table(beh, bk))
    assert "SortMergeJoin" in p_master
    assert shuffles(p_master) == shuffles(p_book) + shuffles(p_beh)


def test_auc_after_the_ranges_needs_no_join_and_no_single_task(no_broadcast):
    spark = no_broadcast
    df = spark.createDataFrame([("d", 0.5, 1), ("d", 0.2, 0)], "g string, score double, label int")
    p = plan(metrics.roc_auc(df, group_cols=["g"]))
    assert "Join" not in p and "SinglePartition" not in p and shuffles(p) <= 3


def test_rank_band_is_one_plan_at_any_depth(no_broadcast):
    spark = no_broadcast
    totals = spark.range(5000).selectExpr("cast(id as string) as nr_cpf_cnpj_receiver", "cast(id % 700 as double) as vl_total_recebido")
    plans = []
    for lo, hi in ((3, 8), (4000, 4500)):
        df = labels.rank_band(totals, lo, hi)
        assert df.count() == hi - lo
        text = plan(df)
        # The only single task is the window over one row per range.
        assert text.count("SinglePartition") == 1 and "TakeOrdered" not in text
        plans.append(re.sub(r"\d+|ranges-[0-9a-f]+", "", text))
    assert plans[0] == plans[1]


def test_hash_sample_shares_one_shuffle_of_the_ids(spark):
    from riskbook.session import scratch_path

    path = scratch_path(spark, "persons")
    spark.createDataFrame([(str(i), "F") for i in range(500)], "nr_cpf_cnpj string, cd_tipo_doc string").write.parquet(path)
    persons = spark.read.parquet(path)
    transfers = spark.createDataFrame([("1", "2024-01-01")], "nr_cpf_cnpj_sender string, dat_ref_carga string")
    df = labels.sample_customers(persons, transfers, 0.02, 42)
    assert df.count() == 10
    df.collect()  # executed plan: the histogram and the ranking reuse one shuffle of the ids
    text = plan(df).split("== Initial Plan ==")[0]
    assert text.count("ReadSchema: struct<nr_cpf_cnpj:string,cd_tipo_doc:string>") == 1 and "Reused" in text
