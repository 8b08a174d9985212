"""Financial features kept up to date batch by batch (B2-B4 without reading old feeds again).

The state is two tables below one folder, partitioned by batch and month:

* ``rows`` — the cleaned transfers that a batch brought for the first time;
* ``pairs`` — their daily pairs, a partial result: amounts and counts of equal keys add up over batches.

A batch is cleaned, compared with the stored rows of its own months only (partition pruning), and what is
new is stored, so a replay in a later batch changes nothing, and late rows of an old day are added to it. Features of any
window are then one aggregate over the pairs of its months. A batch counts once its pairs are
committed; one that was cut off before may simply be run again, as may a whole one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.functions.dates import in_window, window_start
from riskbook.operators.transfers import CHANNEL_COL, GROUP_KEYS, KEY_TYPES, _clean_columns, daily_pairs
from riskbook.sources.versions import _fs

DAY, MONTH = "dat_ref_carga", "mes"
CELL, STORED = "_cell", "_stored"
# Rows of a batch that are dealt together, at most one month's.
CELL_ROWS = 250_000
_TYPED = ", ".join(f"{n} {t}" for n, t in KEY_TYPES)
ROWS = f"{CHANNEL_COL} string, {_TYPED}, vl_titulo double, {DAY} string, batch string, {MONTH} string"
PAIRS = f"{CHANNEL_COL} string, {_TYPED}, vl_titulo double, qtd_titulo int, {DAY} string, batch string, {MONTH} string"


def committed(spark: SparkSession, state: str) -> list[str]:
    """Batches whose pairs are whole, a short list of names."""
    fs, folder = _fs(spark, f"{state}/pairs")
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("batch=") and fs.exists(_fs(spark, f"{state}/pairs/{name}/_SUCCESS")[1]):
            out.append(name.removeprefix("batch="))
    return sorted(out)


def _cells(rows: int) -> list[Column]:
    """A row's month and its part of the month, some ``CELL_ROWS`` long if the month has ``rows`` rows. All rows of one daily
    pair are in one part, and one sender's rows of a day go together, in the order they are read."""
    part = F.pmod(F.xxhash64("nr_cpf_cnpj_sender", DAY), F.lit(max(1, -(-rows // CELL_ROWS))))
    return [F.substring(DAY, 1, 7).alias(MONTH), part.alias(CELL)]


def _write(df: DataFrame, path: str) -> None:
    """By month; ``df`` is dealt by (month, part of the month), so a task writes few months."""
    df.drop(CELL).write.mode("overwrite").option("compression", "zstd").partitionBy(MONTH).parquet(path)


def add_batch(feed: DataFrame, state: str, batch: str, channel_col: str = CHANNEL_COL) -> int:
    """Store what is new in ``feed`` (raw transfers of any days, tagged by channel); returns the number of new rows.

    Two shuffles: the batch meets the stored rows of its months once, which removes repeats inside the batch and replays of stored
    rows together, and what is new is dealt the same way for the daily pairs. Both are written as they were dealt.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
        raise ValueError("a batch name holds letters, digits, _ and - only")
    spark, state = feed.sparkSession, state.rstrip("/")
    dated = in_window(feed, "0001-01-01", "9999-12-31")
    clean = dated.withColumn(CHANNEL_COL, F.col(channel_col).cast("string")).select(*_clean_columns([CHANNEL_COL]))
    clean = clean.filter(F.col("vl_titulo") > 0)
    sizes = {r[0]: r[1] for r in clean.groupBy(F.substring(DAY, 1, 7)).count().collect()}  # calendar months of one batch
    cells = _cells(max(sizes.values(), default=0))
    met = clean.withColumn(STORED, F.lit(False))
    before = [b for b in committed(spark, state) if b != batch]
    if before:
        seen = spark.read.schema(ROWS).option("basePath", f"{state}/rows").parquet(*[f"{state}/rows/batch={b}" for b in before])
        met = met.unionByName(seen.where(F.col(MONTH).isin(list(sizes))).select(*clean.columns, F.lit(True).alias(STORED)))
    met = met.repartition(*cells).select("*", *cells).groupBy(MONTH, CELL, *clean.columns).agg(F.max(STORED).alias(STORED))
    _write(met.where(~F.col(STORED)).drop(STORED), f"{state}/rows/batch={batch}")
    fresh = spark.read.schema(ROWS).option("basePath", f"{state}/rows").parquet(f"{state}/rows/batch={batch}")
    dealt = fresh.drop("batch", MONTH).repartition(*cells).select("*", *cells)
    _write(daily_pairs(dealt, extra_keys=[MONTH, CELL, CHANNEL_COL]), f"{state}/pairs/batch={batch}")
    return fresh.count()


def financial_as_of(spark: SparkSession, state: str, end_date: str, days_to_evaluate: int) -> DataFrame:
    """B4 over all batches committed so far: equal to the features of all their feeds at once."""
    state, batches = state.rstrip("/"), committed(spark, state.rstrip("/"))
    if not batches:
        return spark.createDataFrame([], PAIRS).select(*GROUP_KEYS, "vl_titulo", "qtd_titulo")
    pairs = spark.read.schema(PAIRS).option("basePath", f"{state}/pairs").parquet(*[f"{state}/pairs/batch={b}" for b in batches])
    start = window_start(end_date, days=days_to_evaluate + 1)
    inside = pairs.where(F.col(MONTH).between(start[:7], end_date[:7]) & F.col(DAY).between(start, end_date))
    total = inside.groupBy(CHANNEL_COL, *GROUP_KEYS).agg(F.sum("vl_titulo").alias("vl_titulo"), F.sum("qtd_titulo").cast("int").alias("qtd_titulo"))
    return total.drop(CHANNEL_COL)
