"""A1 / A2: named Parquet tables."""

import contextlib
import io

from riskbook.session import scratch_path
from riskbook.sources.tables import read_table, write_table
from tests.conftest import SF_SMALL


def test_read_table_prunes_the_scan_to_the_requested_columns(spark):
    df = read_table(spark, f"{SF_SMALL}/orders.parquet", ["o_orderkey", "o_orderdate"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp" in buf.getvalue()
    assert df.columns == ["o_orderkey", "o_orderdate"]


def test_write_table_overwrites_and_reads_back(spark):
    path = scratch_path(spark, "roundtrip")
    first = write_table(spark.range(5).toDF("n"), path)
    assert sorted(r.n for r in first.collect()) == [0, 1, 2, 3, 4]
    second = write_table(spark.range(2).toDF("n"), path)
    assert sorted(r.n for r in second.collect()) == [0, 1]
    parts = write_table(spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string"), scratch_path(spark, "parts"), ["p"])
    assert sorted((r.n, r.p) for r in parts.filter("p = 'b'").collect()) == [(2, "b")]
