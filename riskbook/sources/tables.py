"""Named Parquet tables (A1 read, A2 overwrite-and-read-back)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Load a Parquet table. Selecting ``columns`` here lets the scan prune."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """Replace the table at ``path`` with ``df`` and return the written table.

    The write goes through Spark's file committer, so a lost executor only
    re-runs its tasks. Overwriting deletes the old files before the job runs: if
    the job fails, the old table is gone, so write what must survive to a new path. Returning the
    re-read table cuts the lineage: later steps start from Parquet, as the
    named tables between stages do. It has exactly the schema and column order of
    ``df``: partition values are read by their given type, not guessed ('001' stays a string; an
    empty string in a partition column comes back null, as directory names cannot hold it). ``path`` must not be read by ``df``
    itself (Spark refuses to overwrite a path it is reading).
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
