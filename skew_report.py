"""Skew check from Spark's event log: one sender holding a third of all rows.

The input is derived from the given tables: the fixture transfers with the
sender of every third row replaced by one hot sender. The financial
features and the trailing book run over it with the event log written to a
scratch folder; per stage, the report lists the tasks' shuffle records read
(max and median) and durations. For contrast, the same book input is also
shuffled by sender without map-side combining (``repartition``), which is
what a plan without partial aggregation would do.

    python skew_report.py [/root/testdata/sf0.1] [scratch_dir] > SKEW.md
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile


def _stages(log_dir: str) -> list[dict]:
    files = [f for f in glob.glob(os.path.join(log_dir, "*")) if os.path.isfile(f)]
    job_desc, stage_job, tasks = {}, {}, {}
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    job_desc[ev["Job ID"]] = desc
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    sr = m.get("Shuffle Read Metrics") or {}
                    info = ev.get("Task Info") or {}
                    nbytes = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                    tasks.setdefault(ev["Stage ID"], []).append(
                        (sr.get("Total Records Read", 0), info.get("Finish Time", 0) - info.get("Launch Time", 0), nbytes)
                    )
    out = []
    for sid, ts in sorted(tasks.items()):
        desc = job_desc.get(stage_job.get(sid))
        recs = [r for r, _, _ in ts]
        if not desc or max(recs) == 0:
            continue
        durs = [d for _, d, _ in ts]
        out.append(
            {
                "job": desc,
                "stage": sid,
                "tasks": len(ts),
                "records_max": max(recs),
                "records_median": statistics.median(recs),
                "records_total": sum(recs),
                "kb_total": sum(b for _, _, b in ts) / 1024,
                "ms_max": max(durs),
                "ms_median": statistics.median(durs),
            }
        )
    return out


def main(argv: list[str]) -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from riskbook.operators import book, transfers
    from riskbook.session import configure, shared_dir
    from riskbook.sources import fixtures as fx

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    scratch = argv[2] if len(argv) > 2 else tempfile.mkdtemp(prefix="riskbook-skew-")
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir, exist_ok=True)
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("riskbook-skew")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    shared_dir(spark)

    raw = fx.fixture(spark, sf_dir, "transfers_raw")
    hot = F.when(F.pmod(F.xxhash64(*raw.columns), F.lit(3)) == 0, F.lit("HOT")).otherwise(F.col("nr_cpf_cnpj_sender"))
    skewed_path = os.path.join(scratch, "transfers_skewed")
    raw.withColumn("nr_cpf_cnpj_sender", hot).write.mode("overwrite").parquet(skewed_path)
    skewed = spark.read.parquet(skewed_path)
    flagged = fx.fixture(spark, sf_dir, "flagged_table")

    sc = spark.sparkContext
    sc.setJobDescription("financial_features")
    fin_path = os.path.join(scratch, "financial")
    transfers.financial_features(skewed, fx.END_DATE, fx.DAYS_TO_EVALUATE, channel_col="tp_transacao").write.mode(
        "overwrite"
    ).parquet(fin_path)
    fin = spark.read.parquet(fin_path)
    sc.setJobDescription("trailing_book")
    book.trailing_book(fin, flagged, fx.END_DATE, fx.DAYS_TO_EVALUATE).write.format("noop").mode("overwrite").save()
    sc.setJobDescription("contrast: rows shuffled by sender, no map-side combine")
    fin.repartition(16, "nr_cpf_cnpj_sender").groupBy("nr_cpf_cnpj_sender").agg(F.sum("vl_titulo")).write.format(
        "noop"
    ).mode("overwrite").save()
    # Hot receiver: a third of the rows go to one flagged id, and the flagged
    # side is not broadcast; the thresholds of AQE's skew split follow the small input.
    hot_recv = F.when(F.pmod(F.xxhash64(*fin.columns), F.lit(3)) == 1, F.lit("1000001")).otherwise(
        F.col("nr_cpf_cnpj_receiver")
    )
    fin_r = fin.withColumn("nr_cpf_cnpj_receiver", hot_recv)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # measure the shuffled join paths
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    sc.setJobDescription("mark_flagged (hot receiver, no broadcast, AQE skew split)")
    book.mark_flagged(fin_r, flagged).write.format("noop").mode("overwrite").save()
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    sc.setJobDescription("contrast: the same join without the split")
    book.mark_flagged(fin_r, flagged).write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    hot_rows = fin.filter(F.col("nr_cpf_cnpj_sender") == "HOT").count()
    total_rows = fin.count()
    spark.stop()

    print(f"# Skew check ({sf_dir}, 16 shuffle partitions, local[8])\n")
    print(
        "Input: the fixture transfers with the sender of every third row replaced by one hot sender. "
        f"In the financial table, that sender holds {hot_rows:,} of {total_rows:,} rows. For the join rows, "
        "the receiver of every third financial row is also replaced by one flagged id.\n"
    )
    print(
        "Per stage that reads a shuffle: tasks, shuffle records read per task (max / median), total records and "
        "bytes read, task time in ms (max / median).\n"
    )
    print("| job | stage | tasks | records max | records median | records total | shuffle KB read | ms max | ms median |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for s in _stages(log_dir):
        print(
            f"| {s['job']} | {s['stage']} | {s['tasks']} | {s['records_max']:,} | {s['records_median']:,.0f} | "
            f"{s['records_total']:,} | {s['kb_total']:,.0f} | {s['ms_max']} | {s['ms_median']:.0f} |"
        )


if __name__ == "__main__":
    main(sys.argv)
