"""Flagged receivers and default labels (C2-C7), tax-id audit.

The reference derives, from raw transfers and a persons table (one row
per *account*), the flagged-receiver list (a band of the receiver ranking
by amount received from companies) and the default labels (a customer's
last transfer to a flagged receiver, or a random date for a seeded random
sample of customers). Here every step is a distributed DataFrame step:
nothing row-scaled is collected, and the random sample is a hash order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions.joins import join_on
from riskbook.functions.ranking import exact_rank, hash_hex, hash_int, smallest_by_hash
from riskbook.functions.taxid import is_valid_tax_id

ID = "nr_cpf_cnpj"
RECEIVER = "nr_cpf_cnpj_receiver"
SENDER = "nr_cpf_cnpj_sender"
DAY = "dat_ref_carga"


def received_by_type(transfers: DataFrame, persons: DataFrame, doc_type: str = "J") -> DataFrame:
    """Transfers whose receiver is a person of ``doc_type``.

    INNER join to the persons table as it is, one row per account: a
    receiver with k accounts of that type yields each transfer k times (Q5).
    """
    people = persons.filter(F.col("cd_tipo_doc") == doc_type).select(F.col(ID).alias("_person_id"), "cd_tipo_doc")
    return join_on(transfers, people, RECEIVER, "_person_id", "inner")


def receiver_totals(
    transfers: DataFrame,
    persons: DataFrame,
    doc_type: str = "J",
    dedupe_persons: bool = False,
    amount_col: str = "vl_pgto",
) -> DataFrame:
    """Total received per receiver of ``doc_type`` (``vl_total_recebido``).

    Equal to ``sum`` over :func:`received_by_type`, computed without the
    fan-out: transfers are summed per receiver first (partial aggregation,
    so a hot receiver is combined map-side), then multiplied by the number
    of matching person rows (Q5; 1 with ``dedupe_persons``). Both sides of
    the join are one row per id. The product equals the sum of repeated rows
    exactly for integer-valued amounts and up to rounding otherwise.
    """
    sums = transfers.filter(F.col(RECEIVER).isNotNull()).groupBy(RECEIVER).agg(F.sum(amount_col).alias("_sum"))
    people = persons.filter(F.col("cd_tipo_doc") == doc_type).groupBy(F.col(ID).alias(RECEIVER)).agg(
        F.count(F.lit(1)).alias("_k")
    )
    mult = F.lit(1).cast("double") if dedupe_persons else F.col("_k").cast("double")
    return sums.join(people, on=[RECEIVER], how="inner").select(RECEIVER, (F.col("_sum") * mult).alias("vl_total_recebido"))


def rank_band(totals: DataFrame, lo: int, hi: int, id_col: str = RECEIVER, value_col: str = "vl_total_recebido") -> DataFrame:
    """C4: rows ranked ``lo <= rank < hi`` by ``value_col`` descending, ties
    by id (the reference leaves ties arbitrary, Q6); emits (id, fl_cartola=1).

    The same plan for any band: an exact distributed rank (``exact_rank``), whose
    sorted ranges are a written table, then a filter.
    """
    ranked = exact_rank(totals.select(id_col, value_col), F.col(value_col).desc(), F.col(id_col).asc())
    return ranked.filter((F.col("_rank") >= lo) & (F.col("_rank") < hi)).select(
        F.col(id_col).alias(ID), F.lit(1).alias("fl_cartola")
    )


def last_flagged_transfer(transfers: DataFrame, flagged: DataFrame) -> DataFrame:
    """Per sender, the latest date of a transfer to a flagged receiver
    (a semi join: each transfer counts once however often its receiver is
    listed)."""
    ids = flagged.select(F.col(ID).alias("_flagged_id")).distinct()
    hits = join_on(transfers, ids, RECEIVER, "_flagged_id", "left_semi")
    return hits.groupBy(F.col(SENDER).alias(ID)).agg(F.max(DAY).alias("data_ulti_trans_cartola"))


def sample_customers(
    persons: DataFrame,
    transfers: DataFrame,
    fraction: float = 0.005,
    seed: int = 42,
    minimum: int = 1,
    doc_type: str = "F",
) -> DataFrame:
    """A seeded sample of ``max(minimum, int(n * fraction))`` distinct
    customers of ``doc_type``, each with one date among the distinct
    transfer dates (``data_ulti_trans_cartola_1``).

    The reference draws with a driver-side RNG over collected rows. Here the
    draw is the order of ``md5(id:seed)`` (exact, distributed rank — see
    ``smallest_by_hash``) and the date is ``md5(id:seed:date)`` modulo the
    number of dates, whose exact distributed rank names the date. Deterministic, so a re-run task after a
    lost executor draws the same rows.
    """
    ids = persons.filter(F.col("cd_tipo_doc") == doc_type).select(ID).distinct()
    picked = smallest_by_hash(ids, ID, seed, fraction=fraction, minimum=minimum)
    days = exact_rank(transfers.select(DAY).filter(F.col(DAY).isNotNull()).distinct(), DAY)
    draw = hash_int(hash_hex(ID, F.lit(str(seed)), F.lit("date")), 8)
    # One row: the number of dates, joined on a constant key.
    n_days = days.agg(F.max("_rows").alias("_days")).withColumn("_one", F.lit(1))
    placed = picked.withColumn("_one", F.lit(1)).join(n_days, "_one").withColumn("_di", draw % F.col("_days") + 1)
    dates = days.select(F.col("_rank").alias("_di"), F.col(DAY).alias("data_ulti_trans_cartola_1"))
    return placed.join(dates, "_di", "left").select(ID, "data_ulti_trans_cartola_1")


@dataclass
class Labels:
    flagged: DataFrame  # (nr_cpf_cnpj, fl_cartola)
    risks: DataFrame  # (nr_cpf_cnpj, dat_ref_carga, flag_bloqueio)


def derive_labels(
    persons: DataFrame,
    transfers: DataFrame,
    lo: int = 875,
    hi: int = 900,
    fraction: float = 0.005,
    seed: int = 42,
    dedupe_persons: bool = False,
) -> Labels:
    """Flagged receivers (C3 → C4) and default labels: every distinct
    person customer LEFT JOIN its last flagged transfer date LEFT JOIN the
    random sample; the label date is the first non-null, rows without one
    are dropped, ``flag_bloqueio`` = 1."""
    totals = receiver_totals(transfers, persons, "J", dedupe_persons)
    flagged = rank_band(totals, lo, hi)
    last = last_flagged_transfer(transfers, flagged)
    sample = sample_customers(persons, transfers, fraction, seed)
    customers = persons.filter(F.col("cd_tipo_doc") == "F").select(ID).distinct()
    risks = (
        customers.join(last, on=[ID], how="left")
        .join(sample, on=[ID], how="left")
        .select(ID, F.coalesce("data_ulti_trans_cartola", "data_ulti_trans_cartola_1").alias(DAY))
        .filter(F.col(DAY).isNotNull())
        .select(ID, DAY, F.lit(1).alias("flag_bloqueio"))
    )
    return Labels(flagged, risks)


def check_tax_ids(df: DataFrame, id_col: str = ID, type_col: str = "cd_tipo_doc") -> DataFrame:
    """Count of valid (``fl_valido`` = 1) and invalid ids per document type."""
    return (
        df.select(F.col(type_col).alias("cd_tipo_doc"), is_valid_tax_id(id_col, type_col).alias("fl_valido"))
        .groupBy("cd_tipo_doc", "fl_valido")
        .agg(F.count(F.lit(1)).alias("qtd"))
    )


def audit_tax_ids(df: DataFrame, id_col: str = ID, type_col: str = "cd_tipo_doc") -> DataFrame:
    """C8, row form: ``df`` with ``fl_valido`` appended."""
    return df.withColumn("fl_valido", is_valid_tax_id(id_col, type_col))
