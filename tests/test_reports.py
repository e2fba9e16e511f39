"""Materialise-once report jobs give the same results as the lazy keys."""

import datetime as dt
import os
import tempfile

import pytest

from casebook.plans import mart, reports
from casebook.plans.registry import QUERIES
from casebook.sources import bind, drop_table, save_table
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.mark.parametrize("family", reports.FAMILIES)
def test_reports_equal_lazy_queries(spark, family):
    out = tempfile.mkdtemp(prefix=f"casebook-{family}-")
    keys = reports.run(bind(spark, SF), family, out, bound=True)
    qs = QUERIES
    assert keys == [k for k in qs if family in k.split("_")[:2]]
    for k in keys:
        got = spark.read.parquet(f"{out}/{k}")
        exp = qs[k](spark, SF)
        assert rows(got, *exp.columns) == rows(exp), k


def test_clean_table_is_pruned_by_year(spark):
    t = reports.stored(bind(spark, SF), "mart")
    plan = t.clean_weekly_sales.where("calendar_year = 1998")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(calendar_year" in plan


def test_week_bounds_reach_the_stored_table(spark):
    t = reports.stored(bind(spark, SF), "mart")
    for df in (mart.before_after(t), mart.worst_area(t, year=1998)):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "GreaterThanOrEqual(week_number," in plan and "LessThanOrEqual(week_number," in plan


def test_stored_tables_of_two_runs_do_not_meet(spark):
    a, b = (reports.stored(bind(spark, SF), "mart").clean_weekly_sales.inputFiles() for _ in range(2))
    assert not set(a) & set(b)


def test_report_parameters_override(spark):
    t = reports.stored(bind(spark, SF), "mart")
    got = reports.reports(t, "mart", change_year=1997, change_date=dt.date(1997, 6, 16))
    assert rows(got["mart_worst_area"]) == rows(mart.worst_area(t, year=1997))
    assert rows(got["mart_change_week"]) == rows(mart.change_week(t, dt.date(1997, 6, 16), 1997))
    assert rows(got["mart_before_after_4w"]) == rows(mart.before_after(t))


def test_catalog_table_roundtrip(spark):
    df = QUERIES["web_product_funnel"](spark, SF)
    t = save_table(df, "product_info_test")
    assert t.count() == df.count()
    drop_table(spark, "product_info_test")
    assert not spark.catalog.tableExists("product_info_test")


def test_materialized_table_cuts_lineage(spark):
    from casebook.plans import web
    from casebook.sources import bind, materialize
    t = bind(spark, SF)
    stored = materialize(web.product_funnel(t), "product_info_lineage")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert stored.count() == web.product_funnel(t).count()
