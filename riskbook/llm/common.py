"""What the operators of this package share: table access, scratch tables, vocabulary path."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.session import configure, scratch_path

VOCABULARY = "byte_bpe_50k.json"
# Arrow batches stay small even where single texts are long.
ARROW_ROWS = 1000
ARROW_BYTES = 4 << 20


def vocabulary() -> str:
    """Path of the public vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def prepare(spark: SparkSession) -> SparkSession:
    """Session defaults of the library, bounded Arrow batches, and this package's folder on the
    Python path of the workers (a checkout need not be installed, nor be the working folder)."""
    configure(spark)
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: later plans start
    from files that outlive any executor, and nothing is computed twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``, equals ``remainder``; a null id counts as its empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus == remainder
