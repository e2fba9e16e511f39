"""Stored results that grow by deltas, merge, or lie in buckets."""

import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from casebook.operators import bitmaps, count_bitmaps, count_sketches, sketches
from casebook.plans import mart, reports, upkeep, web
from casebook.sources import LiteralTables, bind, drop_table, materialize
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------------ deltas


def test_weekly_deltas_equal_a_rebuild_and_leave_other_years_alone(spark):
    t, path = bind(spark, SF), tempfile.mkdtemp(prefix="casebook-weekly-")
    a, b, c = dt.date(1998, 12, 28), dt.date(2000, 1, 3), dt.date(2001, 1, 1)
    upkeep.store_weekly(t.shipped(None, a), path)
    before = files(path)
    for span in ((a, b), (b, c), (c, None)):
        upkeep.add_weekly(t.shipped(*span), path)
    assert rows(upkeep.clean_weekly(spark, path)) == rows(mart.clean(t), *upkeep.clean_weekly(spark, path).columns)
    after = files(path)
    year = lambda f: int(re.search(r"calendar_year=(\d+)", f)[1])
    old = {f: m for f, m in before.items() if year(f) < 1998}
    assert old and old == {f: m for f, m in after.items() if year(f) < 1998}
    last = {f for f in before if year(f) == 1998}
    assert last and not last & set(after)  # the year that the first delta adds a week to


def test_a_delta_reads_the_touched_years_only(spark):
    t, path = bind(spark, SF), tempfile.mkdtemp(prefix="casebook-weekly-")
    upkeep.store_weekly(t, path)
    stored, delta = spark.read.parquet(path), materialize(upkeep.weekly_partials(t.shipped(dt.date(2001, 1, 1), None)), "d")
    touched = delta.where("calendar_year >= 2001").select("calendar_year").distinct()
    assert "dynamicpruning" in plan_of(stored.join(F.broadcast(touched), "calendar_year", "left_semi"))


def test_empty_and_unparsed_deltas(spark):
    t, path = bind(spark, SF), tempfile.mkdtemp(prefix="casebook-weekly-")
    upkeep.store_weekly(t, path)
    whole = rows(upkeep.clean_weekly(spark, path))
    upkeep.add_weekly(t.shipped(dt.date(2050, 1, 3), None), path)
    assert rows(upkeep.clean_weekly(spark, path)) == whole
    odd = materialize(t.weekly_amounts.limit(1).withColumn("week_date", F.lit("not a date")), "odd")
    for n in (1, 2):  # rows without a year have a folder of their own, and merge there
        upkeep.add_weekly(LiteralTables(weekly_amounts=odd), path)
        lost = spark.read.parquet(path).where("calendar_year is null")
        assert [r.transactions for r in lost.collect()] == [n * odd.first().transactions]


def test_product_deltas_equal_a_rebuild(spark):
    t, path = bind(spark, SF), tempfile.mkdtemp(prefix="casebook-products-")
    events = materialize(t.web_events, "events")
    part = F.pmod(F.xxhash64("visit_id"), F.lit(3))
    deltas = [LiteralTables(web_events=events.where(part == k), page_hierarchy=t.page_hierarchy) for k in range(3)]
    upkeep.store_products(deltas[0], path)
    for d in deltas[1:]:
        upkeep.add_products(d, path)
    assert rows(upkeep.product_info(spark, path)) == rows(web.product_funnel(t))


# --------------------------------------------------------------- distinct counts


def test_bitmaps_merge_exactly(spark):
    data = [(k % 3, k % 2, v) for k in range(60) for v in (k, 40_000 * k, -k, 0, None)]
    df = spark.createDataFrame(data, "g int, h int, id long")
    got = rows(count_bitmaps(materialize(bitmaps(df, ["g", "h"], "id"), "bits"), ["g"], "n"))
    assert got == rows(df.groupBy("g").agg(F.countDistinct("id").alias("n")))
    assert count_bitmaps(bitmaps(df.where("g > 9"), ["g"], "id"), ["g"], "n").count() == 0


def test_sketches_estimate_within_their_error(spark):
    df = spark.range(60_000).selectExpr("id % 7 as g", "cast(id % 20000 as string) as name")
    got = count_sketches(materialize(sketches(df, ["g"], "name"), "sketch"), [], "n").first().n
    assert abs(got / 20_000 - 1) < 0.05


def test_monthly_and_yearly_visits_from_one_stored_table(spark):
    t = reports.stored(bind(spark, SF), "web")
    exact, rough = web.visits_rollup(t), web.visits_rollup_approx(t)
    for df, name in ((exact, "visit_bitmaps"), (rough, "visit_sketches")):
        assert df.inputFiles() and all(f"/{name}/" in f for f in df.inputFiles())  # no event is read again
    assert rows(exact.where("grain = 'month'"), "period", "unique_visit_count") == rows(web.visits_per_month(t))
    close = {r.period: r.unique_visit_count for r in rough.collect()}
    assert all(abs(close[r.period] / r.unique_visit_count - 1) < 0.05 for r in exact.collect())


# ------------------------------------------------------------------------ layout


def test_bucketed_visits_need_no_exchange_by_visit(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = [spark.conf.get(n) for n in names]
    t = reports.stored(bind(spark, SF), "web", buckets=4)
    try:
        for n, v in zip(names, ("-1", "false")):
            spark.conf.set(n, v)
        pages = LiteralTables(web_events=t.web_events, page_hierarchy=F.broadcast(t.page_hierarchy),
                              event_identifier=F.broadcast(t.event_identifier))
        for query in (web.product_funnel, web.purchase_pct, web.checkout_no_purchase_pct, web.visit_bitmaps):
            assert "hashpartitioning(visit_id" not in plan_of(query(pages)), query.__name__
        plain = LiteralTables(web_events=bind(spark, SF).web_events, page_hierarchy=pages.page_hierarchy)
        assert "hashpartitioning(visit_id" in plan_of(web.product_funnel(plain))
        assert rows(web.product_funnel(t)) == rows(web.product_funnel(plain))
    finally:
        for n, v in zip(names, old):
            spark.conf.set(n, v)
        for table in spark.catalog.listTables():
            if table.name.startswith("web_events_"):
                drop_table(spark, table.name)


def test_changes_prune_the_years_of_a_stored_table(spark):
    t = reports.stored(bind(spark, SF), "mart")
    few = mart.before_after_changes(t, since=dt.date(1998, 1, 1))
    assert "dynamicpruning" in plan_of(few)
    assert rows(few) == rows(mart.before_after_changes(bind(spark, SF)).where("change_date >= '1998-01-01'"))


def test_changes_one_by_one(spark):
    t = reports.stored(bind(spark, SF), "mart")
    got = {r.change_date: (r.sales_before, r.sales_after) for r in mart.before_after_changes(t).collect()}
    for day in (dt.date(1998, 6, 15), dt.date(1996, 3, 4)):
        week = mart.change_week(t, day, day.year).first().week_number
        one = mart.before_after(t, ((week - 4, week - 1), (week, week + 3)), day.year).first()
        assert got[day] == (one.sales_before, one.sales_after)


def test_scans_have_declared_schemas(spark):
    """Binding tables starts no job: nothing is read to infer a schema."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("binding", "binding")
    t = bind(spark, SF)
    for name in ("sales", "menu", "members", "customer_nodes", "customer_transactions", "weekly_amounts",
                 "data_mart", "web_events", "page_hierarchy"):
        getattr(t, name)
    assert not tracker.getJobIdsForGroup("binding")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
