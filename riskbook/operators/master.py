"""Model input: master_table (B13) and class_balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ID = "nr_cpf_cnpj"
TARGET = "flag_bloqueio"


def master_table(behavioral: DataFrame, book: DataFrame) -> DataFrame:
    """Book INNER JOIN behavioural features on the customer id.

    Both inputs come out of a ``groupBy(id)``, so both are already hash
    partitioned on the id: the sort-merge join reuses that partitioning and
    adds no shuffle. Keys are unique on both sides, so nothing is skewed.
    Customers without campaign or risk rows drop out (Q14).
    """
    return book.join(behavioral, on=[ID], how="inner")


def class_balance(master: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows per target value."""
    return master.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
