"""Physical-plan report for the operators over production-shaped inputs.

Writes the fixture inputs of one scale folder as plain Parquet tables (as
the raw feeds would arrive), builds every operator over them, and prints a
markdown table from each executed (AQE final) plan: shuffles, broadcasts,
joins, windows, scans with the columns they read and the filters pushed
into Parquet.

    python plan_report.py [/root/testdata/sf0.1] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
import time

from pyspark.sql import DataFrame


def _plan_text(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    # keep the final plan only
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


def _summary(name: str, df: DataFrame) -> tuple[list[str], list[str]]:
    t0 = time.perf_counter()
    n = df.count()
    if n <= 500_000:
        df.collect()  # executes this DataFrame's own plan, so explain shows the AQE final plan
        kind = "final"
    else:
        df.write.format("noop").mode("overwrite").save()  # big output: do not pull rows to the driver
        kind = "initial"
    secs = time.perf_counter() - t0
    p = _plan_text(df)
    shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", p))
    single = p.count("Exchange SinglePartition")
    bcast = p.count("BroadcastExchange")
    smj, bhj = p.count("SortMergeJoin"), p.count("BroadcastHashJoin")
    windows = len(re.findall(r"\bWindow \[", p))
    topk = p.count("TakeOrderedAndProject")
    details = []
    for line in p.splitlines():
        if "FileScan parquet" not in line:
            continue
        cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
        pushed = re.search(r"PushedFilters: \[(.*?)(\], ReadSchema|$)", line)
        ncols = len([c for c in (cols.group(1) if cols else "").split(",") if c.strip()])
        details.append(f"{ncols} cols; pushed: {(pushed.group(1) if pushed else '')[:110] or '-'}")
    row = [name, str(n), f"{secs:.2f}", kind, str(shuffles), str(single), str(bcast), str(smj), str(bhj), str(windows), str(topk), str(len(details))]
    return row, details


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    from riskbook.operators import behavior, book, labels, master, metrics, transfers
    from riskbook.session import local_session, scratch_path
    from riskbook.sources import fixtures as fx

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(app="riskbook-plans")
    base = scratch_path(spark, "raw")
    names = ["transfers_raw", "persons", "raw_campanhas", "raw_riscos", "flagged_table", "score_history", "tax_ids"]
    for n in names:
        fx.fixture(spark, sf_dir, n).write.mode("overwrite").parquet(f"{base}/{n}")
    for ch, df in fx.raw_channels(spark, sf_dir).items():
        df.write.mode("overwrite").parquet(f"{base}/raw_{ch.lower()}")
    rd = lambda n: spark.read.parquet(f"{base}/{n}")
    E, N = fx.END_DATE, fx.DAYS_TO_EVALUATE
    feeds = {c: rd(f"raw_{c.lower()}") for c in fx.CHANNELS}
    transfers_all = rd("transfers_raw").drop("tp_transacao")
    fin = transfers.financial_features(feeds, E, N)
    beh = behavior.behavioral_features(rd("raw_campanhas"), rd("raw_riscos"), E, N)
    bk = book.trailing_book(fin, rd("flagged_table"), E, N)
    derived = labels.derive_labels(rd("persons"), transfers_all, fx.RANK_LO, fx.RANK_HI, fx.SAMPLE_FRACTION, fx.SEED)
    daily = metrics.auc_by_date(rd("score_history"))
    plans = {
        "financial_features (3 feeds)": fin,
        "financial_features (tagged)": transfers.financial_features(rd("transfers_raw"), E, N, channel_col="tp_transacao"),
        "behavioral_features": beh,
        "trailing_book": bk,
        "master_table": master.master_table(beh, bk),
        "received_by_type": labels.received_by_type(transfers_all, rd("persons")),
        "receiver_totals": labels.receiver_totals(transfers_all, rd("persons")),
        "rank_band": labels.rank_band(labels.receiver_totals(transfers_all, rd("persons")), fx.RANK_LO, fx.RANK_HI),
        "sample_customers": labels.sample_customers(rd("persons"), transfers_all, fx.SAMPLE_FRACTION, fx.SEED),
        "derive_labels": derived.risks,
        "check_tax_ids": labels.check_tax_ids(rd("tax_ids")),
        "auc_by_date": daily,
        "needs_retrain": metrics.needs_retrain(daily, fx.RETRAIN_THRESHOLD),
    }
    header = ["operator", "rows", "sec", "plan", "shuffles", "single-partition", "broadcasts", "SMJ", "BHJ", "windows", "top-k", "scans"]
    print(f"# Physical plans over Parquet inputs ({sf_dir}, local mode, AQE final plans)\n")
    print("Generated by `python plan_report.py`. Inputs: the fixture tables written as plain Parquet.\n")
    print("| " + " | ".join(header) + " |")
    print("| " + " | ".join("---" for _ in header) + " |")
    scan_notes = []
    for name, df in plans.items():
        row, details = _summary(name, df)
        print("| " + " | ".join(row) + " |")
        scan_notes.append((name, details))
    print("\n## Scans (columns read; filters pushed into Parquet)\n")
    for name, details in scan_notes:
        print(f"- **{name}**: " + "; ".join(f"scan {i + 1}: {d}" for i, d in enumerate(details)))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
