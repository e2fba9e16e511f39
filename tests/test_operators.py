"""Skew-safe operators against the plain per-key windows they replace."""

import datetime as dt
import random

from pyspark.sql import Window, functions as F

from casebook.operators import (
    dyadic_nodes, fill_months, first_ranked, interval_join, keep_extreme, membership_flag, next_date_in_order, not_in_values,
    rank_by, rows_at_max, running_total_by_day, sessionize, unpivot_dims,
)
from tests.conftest import rows

random.seed(7)


def _facts(spark, n=400):
    base = dt.date(2020, 1, 1)
    data = [(random.choice("abc"), base + dt.timedelta(days=random.randint(0, 20)),
             random.randint(-50, 100), i) for i in range(n)]
    data.append(("a", None, 5, n))           # NULL order value
    return spark.createDataFrame(data, "k string, d date, v int, id int")


def test_rank_by_equals_window_rank(spark):
    df = _facts(spark)
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_first())
    exp = df.withColumn("r", F.rank().over(w)).withColumn("dr", F.dense_rank().over(w))
    got = rank_by(rank_by(df, ["k"], "d", "r"), ["k"], "d", "dr", dense=True)
    assert rows(got, "id", "r", "dr") == rows(exp, "id", "r", "dr")


def test_keep_extreme_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 3, 3), ("b", 5, 4)],
                               "k string, v int, id int")
    assert rows(keep_extreme(df, ["k"], "v", "min"), "id") == [(1,), (2,), (4,)]
    assert rows(keep_extreme(df, ["k"], "v", "max"), "id") == [(3,), (4,)]


def test_next_date_equals_lead(spark):
    base = dt.datetime(2020, 1, 1)
    data = [(random.choice([1, 2, 3]), i,
             base + dt.timedelta(days=random.randint(0, 30), hours=random.choice([0, 0, 5])))
            for i in range(300)]
    df = spark.createDataFrame(data, "c int, ok int, ts timestamp_ntz")
    w = Window.partitionBy("c").orderBy("ts", "ok")
    exp = df.withColumn("e", F.coalesce(F.to_date(F.lead("ts").over(w)),
                                        F.lit(dt.date(9999, 12, 31))))
    got = next_date_in_order(df, "c", "ts", "ok", "e")
    assert rows(got, "ok", "e") == rows(exp, "ok", "e")


def test_sessionize_equals_lag_window(spark):
    base = dt.datetime(2024, 1, 1)
    data, t = [], {u: base for u in range(5)}
    for i in range(600):
        u = random.randint(0, 4)
        step = random.choice([dt.timedelta(minutes=5), dt.timedelta(hours=3),
                              dt.timedelta(hours=12), dt.timedelta(hours=12, seconds=1),
                              dt.timedelta(hours=30), dt.timedelta(0)])
        t[u] = t[u] + step
        data.append((u, i, t[u]))
    df = spark.createDataFrame(data, "u int, id int, ts timestamp_ntz")
    w = Window.partitionBy("u").orderBy("ts", "id")
    prev = F.lag("ts").over(w)
    new = F.when(prev.isNull() | (F.col("ts") > prev + F.expr("INTERVAL 12 HOURS")), 1) \
        .otherwise(0)
    exp = df.withColumn("n", new).withColumn(
        "s", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = sessionize(df, "u", "ts", "s", 12)
    assert rows(got, "id", "s") == rows(exp, "id", "s")


def test_running_total_by_day_equals_range_window(spark):
    df = _facts(spark).where(F.col("d").isNotNull())
    w = Window.partitionBy("k").orderBy("d")          # default RANGE frame
    exp = df.withColumn("rt", F.sum("v").over(w)).select("k", "d", "rt").distinct()
    got = running_total_by_day(df, "k", "d", F.col("v"), "rt").select("k", "d", "rt")
    assert rows(got) == rows(exp)


def test_not_in_values_null_semantics(spark):
    seq = spark.range(1, 6).withColumnRenamed("id", "x")
    vals = spark.createDataFrame([(2,), (4,)], "w bigint")
    assert rows(not_in_values(seq, "x", vals, "w")) == [(1,), (3,), (5,)]
    with_null = spark.createDataFrame([(2,), (None,)], "w bigint")
    assert not_in_values(seq, "x", with_null, "w").count() == 0


def test_interval_join(spark):
    facts = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 2, 0, 0)), (2, dt.datetime(2024, 1, 9, 0, 0)),
         (3, dt.datetime(2024, 1, 9, 0, 1)), (4, dt.datetime(2024, 1, 5, 12)), (5, None)],
        "id int, ts timestamp_ntz")
    dim = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 9)),
         ("B", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)),    # overlaps A
         ("C", dt.datetime(2024, 1, 9, 0, 1), dt.datetime(9999, 12, 31)),  # open end
         ("D", dt.datetime(1999, 1, 1), dt.datetime(1999, 1, 2)),    # before all facts
         ("E", dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 2)),    # ends before it starts
         ("F", None, dt.datetime(2024, 1, 9))],
        "name string, s timestamp_ntz, e timestamp_ntz")
    exp = [(1, "A"), (2, "A"), (3, "C"), (4, "A"), (4, "B"), (5, None)]
    assert rows(interval_join(facts, "ts", dim, "s", "e", ["id"]), "id", "name") == exp
    none = facts.where("id = 0")
    assert interval_join(none, "ts", dim, "s", "e", ["id"]).count() == 0
    for few in ("name = 'D'", "name = 'X'"):
        assert rows(interval_join(facts, "ts", dim.where(few), "s", "e", ["id"]), "name") == [(None,)] * 5


def test_interval_join_equals_brute_force_on_many_overlapping_intervals(spark):
    rng = random.Random(3)
    day = lambda: dt.datetime(2001, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 4000))
    points = [(i, day()) for i in range(400)]
    spans = []
    for i in range(150):
        s, e = sorted((day(), day()))
        spans.append((f"n{i}", s, dt.datetime(9999, 12, 31) if i % 11 == 0 else e))
    facts = spark.createDataFrame(points, "id int, ts timestamp_ntz")
    dim = spark.createDataFrame(spans, "name string, s timestamp_ntz, e timestamp_ntz")
    got = rows(interval_join(facts, "ts", dim, "s", "e", ["id"]), "id", "name")
    assert [r for r in got if r[1]] == sorted((i, n) for i, p in points for n, s, e in spans if s <= p <= e)


def test_dyadic_nodes_cover_an_interval_once(spark):
    rng = random.Random(4)
    spans = [(a, a + rng.choice([-1, 0, 1, 2, 7, 100, 3000])) for a in (rng.randint(-3000, 3000) for _ in range(300))]
    df = spark.createDataFrame(spans, "a int, b int").select(
        "a", "b", dyadic_nodes(F.col("a"), F.col("b")).alias("nodes"))
    for r in df.collect():
        covered = sorted(x for n in r.nodes or [] for x in range(n.node << n.level, n.node + 1 << n.level))
        assert covered == list(range(r.a, r.b + 1))
        assert len(r.nodes or []) <= 2 * max(1, (r.b - r.a + 2).bit_length())
    wide = spark.createDataFrame([(-(10 ** 6), 2932896)], "a int, b int")  # to the last date
    assert len(wide.select(dyadic_nodes(F.col("a"), F.col("b"))).first()[0]) <= 2 * 22


def test_fill_months(spark):
    data = [("a", dt.date(2023, 11, 1), 5, 5), ("a", dt.date(2024, 2, 1), 7, 2), ("b", dt.date(2024, 1, 1), 1, 1)]
    df = spark.createDataFrame(data, "k string, m date, bal int, net int")
    got = rows(fill_months(df, "k", "m", ["bal"], ["net"]))
    assert got == [("a", dt.date(2023, 11, 1), 5, 5), ("a", dt.date(2023, 12, 1), 5, 0),
                   ("a", dt.date(2024, 1, 1), 5, 0), ("a", dt.date(2024, 2, 1), 7, 2), ("b", dt.date(2024, 1, 1), 1, 1)]
    assert fill_months(df.where("k = 'c'"), "k", "m", ["bal"]).count() == 0


def test_first_ranked_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 3, "w")],
                               "k string, v int, n string")
    assert rows(first_ranked(df, ["k"], F.asc("v")), "k", "n") == [("a", "x"), ("a", "y"), ("b", "w")]
    assert rows(first_ranked(df, ["k"], F.desc("v"), dense=True), "n") == [("w",), ("z",)]


def test_membership_flag_no_fanout(spark):
    df = spark.createDataFrame([("v1",), ("v2",)], "visit string")
    keys = spark.createDataFrame([("v1",), ("v1",)], "visit string")
    assert rows(membership_flag(df, keys, "visit", "f"), "visit", "f") == [("v1", 1), ("v2", 0)]


def test_rows_at_max_and_unpivot(spark):
    df = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1)], "n string, v int")
    assert rows(rows_at_max(df, "v"), "n") == [("a",), ("b",)]
    wide = spark.createDataFrame([(1, "x", None)], "s int, d1 string, d2 string")
    long = unpivot_dims(wide, ["d1", "d2"], ["s"])
    assert rows(long, "metric", "value") == [("d1", "x"), ("d2", None)]


def test_sessionize_instants_across_daylight_saving(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2024-03-10 02:00 local does not exist; the 00:00-12:00 local bucket
        # lasts 11 hours and the autumn one 13 hours.
        base = dt.datetime(2024, 3, 9, 12, 0)
        steps = [0, 3600 * 11, 3600 * 12 + 1800, 60, 3600 * 12, 3600 * 12 + 1]
        data, t = [], base
        for i, s in enumerate(steps):
            t = t + dt.timedelta(seconds=s)
            data.append((1, i, t.strftime("%Y-%m-%d %H:%M:%S")))
        base2 = dt.datetime(2024, 11, 2, 18, 0)
        t = base2
        for i, s in enumerate([0, 3600 * 6, 3600 * 12, 3600 * 12 + 60, 3600 * 13]):
            t = t + dt.timedelta(seconds=s)
            data.append((2, 100 + i, t.strftime("%Y-%m-%d %H:%M:%S")))
        # 00:10 EDT and 11:50 EST on the fall-back day are 12 h 40 min apart
        # but share the local 00:00-12:00 bucket: they must be two visits.
        data += [(3, 200, "2024-11-03 00:10:00"), (3, 201, "2024-11-03 11:50:00")]
        df = spark.createDataFrame(data, "u int, id int, s string") \
            .withColumn("ts", F.to_timestamp("s"))
        w = Window.partitionBy("u").orderBy("ts", "id")
        prev = F.lag("ts").over(w)
        new = F.when(prev.isNull() | (F.col("ts") > prev + F.expr("INTERVAL 12 HOURS")), 1) \
            .otherwise(0)
        exp = df.withColumn("n", new).withColumn(
            "v", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        got = rows(sessionize(df, "u", "ts", "v", 12), "id", "v")
        assert got == rows(exp, "id", "v")
        assert (201, 2) in got
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
