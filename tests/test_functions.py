"""Dialect functions against brute force."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from casebook.functions import (
    int_avg, int_div, month_name, parse_dmy2, pct_change, ratio, us_week, weekday_name,
)


def _sunday_week(d: dt.date) -> int:
    """Week 1 holds 1 January; a new week starts every Sunday."""
    week, cur = 1, dt.date(d.year, 1, 1)
    while cur < d:
        cur += dt.timedelta(days=1)
        if cur.weekday() == 6:  # Sunday
            week += 1
    return week


def test_us_week_matches_day_by_day_count(spark):
    start = dt.date(1995, 1, 1)
    days = 365 * 8 + 2
    df = spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    got = {r.d: r.w for r in df.select("d", us_week("d").alias("w")).collect()}
    for i in range(days):
        d = start + dt.timedelta(days=i)
        assert got[d] == _sunday_week(d), d


def test_us_week_edges(spark):
    df = spark.createDataFrame([(dt.date(2000, 12, 31),), (dt.date(2018, 1, 7),),
                                (dt.date(2018, 1, 1),), (dt.date(2020, 6, 15),)], "d date")
    got = dict(df.select("d", us_week("d").alias("w")).collect())
    assert got[dt.date(2000, 12, 31)] == 54    # leap year starting on Saturday
    assert got[dt.date(2018, 1, 7)] == 2       # first Sunday opens week 2
    assert got[dt.date(2018, 1, 1)] == 1
    assert got[dt.date(2020, 6, 15)] == 25


def test_parse_dmy2_century_and_invalid(spark):
    cases = {"15/6/98": dt.date(1998, 6, 15), "1/1/50": dt.date(1950, 1, 1),
             "1/1/49": dt.date(2049, 1, 1), "29/2/96": dt.date(1996, 2, 29),
             "31/2/20": None, "not a date": None, "2/3/01": dt.date(2001, 3, 2)}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = dict(df.select("s", parse_dmy2("s").alias("d")).collect())
    assert got == cases


def test_integer_division_and_average_truncate(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (5, 0), (None, 3)], "a int, b int")
    got = [r.q for r in df.select(int_div("a", "b").alias("q")).collect()]
    assert got == [3, -3, None, None]
    avg = spark.createDataFrame([(1,), (2,), (2,), (None,)], "x int").agg(int_avg("x").alias("m"))
    assert avg.first().m == 1        # (1+2+2) / 3 = 1.67 -> 1


def test_ratio_guard_and_rounding(spark):
    df = spark.createDataFrame([(57, 200), (1, 0), (1, 8)], "a bigint, b bigint")
    got = [r.r for r in df.select(F.round(ratio("a", "b"), 2).alias("r")).collect()]
    assert got == [0.29, None, 0.13]   # 0.285 rounds half up on its decimal form
    pc = spark.createDataFrame([(110, 100), (5, 0)], "a bigint, b bigint") \
        .select(pct_change("a", "b", 1).alias("p")).collect()
    assert [r.p for r in pc] == [10.0, None]


def test_names(spark):
    df = spark.createDataFrame([(dt.date(2020, 6, 15),)], "d date")
    r = df.select(month_name("d").alias("m"), weekday_name("d").alias("w")).first()
    assert (r.m, r.w) == ("June", "Monday")


def test_decimal_money_is_exact(spark):
    df = spark.createDataFrame([(Decimal("0.10"),)] * 10, "x decimal(18,2)")
    assert df.agg(F.sum("x")).first()[0] == Decimal("1.00")


def test_us_week_of_text_equals_week_of_parsed(spark):
    from casebook.functions import us_week_of_dmy2
    start = dt.date(1948, 1, 1)
    df = spark.range(0, 365 * 110, 3).select(
        F.date_format(F.date_add(F.lit(start), F.col("id").cast("int")), "d/M/yy").alias("s"))
    df = df.unionByName(spark.createDataFrame([("31/2/20",), ("x/y/zz",), ("1/1/2020",),
                                               (None,)], "s string"))
    bad = df.where(~us_week_of_dmy2("s").eqNullSafe(us_week(parse_dmy2("s"))))
    assert bad.count() == 0
