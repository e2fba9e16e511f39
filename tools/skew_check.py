"""Hot-key check: largest per-task shuffle input, naive window vs casebook.

Derives a skewed copy of the events in which one user holds a third of all
rows, then sessionises it twice, with a per-user window over raw rows and
with ``casebook.operators.sessionize``.  Both results are compared; the
largest number of shuffle records any single task reads is taken from
Spark's event log (written to a scratch folder).

Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="casebook-skew-")
    from pyspark.sql import Window, functions as F
    from casebook.operators import sessionize
    from casebook.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=16,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch,
                             "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                        .otherwise(F.col("user_id")))
    n_hot = hot.where(F.col("user_id") == 0).count()

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    prev = F.lag("ts").over(w)
    new = F.when(prev.isNull() | (F.col("ts") > prev + F.expr("INTERVAL 12 HOURS")), 1) \
        .otherwise(0)
    naive = hot.withColumn("_n", new).withColumn(
        "visit", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_n")
    ours = sessionize(hot, "user_id", "ts", "visit", 12)

    spark.sparkContext.setJobGroup("sessions_naive", "x")
    a = naive.select("event_id", "visit").collect()
    spark.sparkContext.setJobGroup("sessions_casebook", "x")
    b = ours.select("event_id", "visit").collect()
    same = {"sessions": sorted(map(tuple, a)) == sorted(map(tuple, b))}

    # Orders with one customer holding a third of them: running balance
    # (RANGE frame) and RANK by day, raw-row windows against casebook.
    from casebook.operators import keep_extreme, next_date_in_order, rank_by, \
        running_total_by_day
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey"))
        .alias("c"), F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").cast("decimal(18,2)").alias("x"))
    wr = Window.partitionBy("c").orderBy("d")
    naive_run = o.withColumn("r", F.sum("x").over(wr)).select("c", "d", "r").distinct()
    ours_run = running_total_by_day(o, "c", "d", F.col("x"), "r").select("c", "d", "r")
    naive_rank = o.withColumn("k", F.rank().over(wr)).select("o_orderkey", "k")
    ours_rank = rank_by(o, ["c"], "d", "k").select("o_orderkey", "k")
    wl = Window.partitionBy("c").orderBy("d", "o_orderkey")
    naive_next = o.withColumn("e", F.coalesce(F.lead("d").over(wl), F.lit("9999-12-31")
                                              .cast("date"))).select("o_orderkey", "e")
    ours_next = next_date_in_order(o, "c", "d", "o_orderkey", "e").select("o_orderkey", "e")
    naive_min = (o.withColumn("_r", F.rank().over(wr)).where(F.col("_r") == 1)
                 .select("o_orderkey"))
    ours_min = keep_extreme(o, ["c"], "d", "min").select("o_orderkey")
    for name, df_a, df_b in (("running", naive_run, ours_run), ("rank", naive_rank, ours_rank),
                             ("next_date", naive_next, ours_next),
                             ("group_min", naive_min, ours_min)):
        spark.sparkContext.setJobGroup(f"{name}_naive", "x")
        ra = sorted(map(tuple, df_a.collect()))
        spark.sparkContext.setJobGroup(f"{name}_casebook", "x")
        rb = sorted(map(tuple, df_b.collect()))
        same[name] = ra == rb
    spark.stop()

    import zstandard
    jobs, stage_group, max_read = {}, {}, {}
    for f in glob.glob(f"{scratch}/*/events_*") + glob.glob(f"{scratch}/*"):
        if os.path.isdir(f):
            continue
        raw = open(f, "rb")
        text = (io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                if f.endswith(".zstd") else io.TextIOWrapper(raw, encoding="utf-8"))
        for line in text:
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                group = stage_group.get(e["Stage ID"])
                if group:
                    max_read[group] = max(max_read.get(group, 0), m.get("Total Records Read", 0))
    print(json.dumps({"event_rows": len(a), "hot_user_rows": n_hot, "same_result": same,
                      "max_shuffle_records_one_task": max_read}))


if __name__ == "__main__":
    main()
