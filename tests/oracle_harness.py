"""Spark-vs-DuckDB comparison, the same checks the driver runs: row count,
column names, and an order-insensitive hash of the values.

Run all keys: ``python -m tests.oracle_harness /root/testdata/sf0.01 [key ...]``.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        # A column of whole numbers with nulls comes as floats from one engine and as integers from the other.
        return int(v) if v.is_integer() else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def frame_digest(pdf: pd.DataFrame) -> tuple[list[str], int, str, list[tuple]]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    rows.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    digest = hashlib.sha256(repr(rows).encode()).hexdigest()
    return cols, len(rows), digest, rows


def compare(spark, name: str, sf_dir: str, query, sql: str | None, con=None) -> dict:
    t0 = time.time()
    spdf = query(spark, sf_dir).toPandas()
    t1 = time.time()
    out = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck_connect(sf_dir)
    dkdf = con.sql(sql).df()
    out["oracle_rows"] = len(dkdf)
    sc, sn, sh, srows = frame_digest(spdf)
    dc, dn, dh, drows = frame_digest(dkdf)
    ok = sc == dc and sn == dn and sh == dh
    out["status"] = "match" if ok else "MISMATCH"
    if not ok:
        if sc != dc:
            out["cols"] = (sorted(set(sc) - set(dc)), sorted(set(dc) - set(sc)))
        else:
            a, b = set(srows), set(drows)
            out["only_spark"] = sorted(a - b, key=str)[:3]
            out["only_oracle"] = sorted(b - a, key=str)[:3]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    from riskbook.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(entry.queries())
    spark = local_session()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connect(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, qs[k], sqls.get(k), con)
        except Exception as e:  # report and continue
            r = {"name": k, "status": "ERROR", "error": str(e)[:800]}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
