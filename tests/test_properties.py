"""Property tests: the calendar-grain rewrites equal the raw-row windows."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from casebook.operators import next_date_in_order, rank_by, sessionize
from tests.conftest import rows

BASE = dt.datetime(2024, 1, 1)
# Steps chosen to hit bucket edges and the exact 12-hour gap.
STEPS = st.sampled_from([0, 1, 3600, 6 * 3600, 12 * 3600 - 1, 12 * 3600, 12 * 3600 + 1,
                         24 * 3600, 36 * 3600, 5 * 86400])
EVENTS = st.lists(st.tuples(st.integers(0, 3), STEPS), min_size=1, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _events(spark, steps):
    clock, data = {}, []
    for i, (u, step) in enumerate(steps):
        clock[u] = clock.get(u, BASE + dt.timedelta(hours=11, minutes=59)) \
            + dt.timedelta(seconds=step)
        data.append((u, i, clock[u]))
    return spark.createDataFrame(data, "u int, id int, ts timestamp_ntz")


@SETTINGS
@given(EVENTS)
def test_sessionize_property(spark, steps):
    df = _events(spark, steps)
    w = Window.partitionBy("u").orderBy("ts", "id")
    prev = F.lag("ts").over(w)
    new = F.when(prev.isNull() | (F.col("ts") > prev + F.expr("INTERVAL 12 HOURS")), 1) \
        .otherwise(0)
    exp = df.withColumn("n", new).withColumn(
        "s", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(sessionize(df, "u", "ts", "s", 12), "id", "s") == rows(exp, "id", "s")


@SETTINGS
@given(EVENTS)
def test_next_date_property(spark, steps):
    df = _events(spark, steps)
    w = Window.partitionBy("u").orderBy("ts", "id")
    exp = df.withColumn("e", F.coalesce(F.to_date(F.lead("ts").over(w)),
                                        F.lit(dt.date(9999, 12, 31))))
    assert rows(next_date_in_order(df, "u", "ts", "id", "e"), "id", "e") == rows(exp, "id", "e")


@SETTINGS
@given(EVENTS)
def test_rank_property(spark, steps):
    df = _events(spark, steps).withColumn("d", F.to_date("ts"))
    w = Window.partitionBy("u").orderBy("d")
    exp = df.withColumn("r", F.rank().over(w))
    assert rows(rank_by(df, ["u"], "d", "r"), "id", "r") == rows(exp, "id", "r")
