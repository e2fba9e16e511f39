"""Streaming allocation equals the batch report on the same transactions."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from casebook.plans import bank
from casebook.sources import bind
from casebook.streaming import allocation_rows, monthly_allocation, running_balance_stream
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    t = bind(spark, SF)
    tx = t.customer_transactions
    src = tempfile.mkdtemp(prefix="casebook-stream-src-")
    # Two arrivals split by date, so every day lies inside one micro-batch.
    tx.where(F.col("txn_date") < "1998-01-01").coalesce(1).write.parquet(os.path.join(src, "a"))
    tx.where(F.col("txn_date") >= "1998-01-01").coalesce(1).write.parquet(os.path.join(src, "b"))
    files = sorted(os.path.join(dp, f) for dp, _, fs in os.walk(src)
                   for f in fs if f.endswith(".parquet"))
    inbox = tempfile.mkdtemp(prefix="casebook-stream-in-")
    stream = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    out = (allocation_rows(running_balance_stream(stream))
           .writeStream.format("memory").queryName("alloc_rows").outputMode("append")
           .option("checkpointLocation", tempfile.mkdtemp(prefix="casebook-stream-ck-"))
           .start())
    try:
        for i, f in enumerate(files):
            os.link(f, os.path.join(inbox, f"part-{i}.parquet"))
            out.processAllAvailable()
    finally:
        out.stop()
    streamed = monthly_allocation(spark.table("alloc_rows"))
    assert rows(streamed) == rows(bank.alloc_running(t))


def test_session_windows_match_batch_visits(spark):
    from casebook.streaming import visit_summary_stream
    raw = spark.read.parquet(f"{SF}/events.parquet")
    inbox = tempfile.mkdtemp(prefix="casebook-ev-in-")
    raw.where(F.col("ts") < "2024-01-15").coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(raw.schema).parquet(inbox)
    q = (visit_summary_stream(stream).writeStream.format("memory").queryName("visits")
         .outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="casebook-ev-ck-")).start())
    try:
        q.processAllAvailable()
        raw.where(F.col("ts") >= "2024-01-15").coalesce(1).write.mode("append").parquet(inbox)
        q.processAllAvailable()
        # a far-future event moves the watermark past every real visit
        late = spark.createDataFrame([(10**9, "2030-01-01 00:00:00", 10**6, "view", 0.0, "{}")],
                                     "event_id long, ts string, user_id long, event_type string,"
                                     " value double, props string") \
            .withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*raw.columns)
        late.write.mode("append").parquet(inbox)
        q.processAllAvailable()
        late.write.mode("append").parquet(inbox)   # one more batch to emit closed windows
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = spark.table("visits").where(F.col("user_id") != 10**6)
    batch = (bind(spark, SF).web_events
             .groupBy("visit_id")
             .agg(F.min("event_time").alias("s"), F.count(F.lit(1)).alias("n"),
                  F.count(F.when(F.col("event_type") == 1, 1)).alias("v"),
                  F.count(F.when(F.col("event_type") == 2, 1)).alias("c"),
                  F.max(F.when(F.col("event_type") == 3, 1).otherwise(0)).alias("p"))
             .select(F.split("visit_id", "-")[0].cast("long").alias("u"), "s", "n", "v", "c", "p"))
    assert rows(streamed, "user_id", "visit_start", "events", "page_views", "cart_adds",
                "purchase") == rows(batch, "u", "s", "n", "v", "c", "p")


def _corrections(spark, arrivals, schema, lateness_days, name):
    """The rows that a stream of ``arrivals``, one micro-batch each, sends."""
    from casebook.streaming import STATE_STORE, corrected_balance_stream
    old = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    inbox = tempfile.mkdtemp(prefix="casebook-late-in-")
    stream = spark.readStream.schema(schema).parquet(inbox)
    q = (corrected_balance_stream(stream, lateness_days).writeStream.format("memory").queryName(name)
         .outputMode("update").option("checkpointLocation", tempfile.mkdtemp(prefix="casebook-late-ck-")).start())
    try:
        for df in arrivals:
            df.coalesce(1).write.mode("append").parquet(inbox)
            q.processAllAvailable()
    finally:
        q.stop()
        if old is None:
            spark.conf.unset(STATE_STORE[0])
        else:
            spark.conf.set(STATE_STORE[0], old)
    return spark.table(name)


def test_shuffled_arrival_matches_batch(spark):
    """Rows of any day in any micro-batch: the last versions are the batch result."""
    from casebook.streaming import latest
    t = bind(spark, SF)
    tx = t.customer_transactions
    part = F.pmod(F.xxhash64("customer_id", "txn_date", "txn_amount"), F.lit(3))
    sent = _corrections(spark, [tx.where(part == k) for k in range(3)], tx.schema, 4000, "shuffled")
    assert sent.count() > latest(sent).count()  # some days were corrected
    assert rows(monthly_allocation(allocation_rows(latest(sent)))) == rows(bank.alloc_running(t))


def test_closed_days_are_folded_and_too_late_rows_dropped(spark):
    schema = "customer_id int, txn_date date, txn_type string, txn_amount int"
    day = lambda d, amount: (1, dt.date(2020, 1, d), "deposit", amount)
    arrivals = [[day(1, 5), day(2, 7)], [day(20, 1)], [day(19, 2)], [day(2, 1000)], [day(21, 4)]]
    sent = _corrections(spark, [spark.createDataFrame(a, schema) for a in arrivals],
                        spark.createDataFrame([], schema).schema, 3, "closed")
    from casebook.streaming import latest
    got = {r.txn_date.day: (r.n_rows, r.running_cents) for r in latest(sent).collect()}
    assert got == {1: (1, 500), 2: (1, 1200), 19: (1, 1400), 20: (1, 1500), 21: (1, 1900)}
    again = [r.txn_date.day for r in sent.where("version > 3").collect()]
    assert set(again) <= {19, 20, 21}  # the folded days were not sent again
