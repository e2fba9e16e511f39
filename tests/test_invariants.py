"""Invariants of the analyses on the driver's sf0.01 data."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casebook.plans.registry import QUERIES
from casebook.plans import web
from casebook.sources import bind

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def q(spark, key):
    return QUERIES[key](spark, SF)


def test_platform_shares_sum_to_100(spark):
    for r in q(spark, "mart_platform_share").collect():
        if r.retail is not None and r.shopify is not None:
            assert abs(r.retail + r.shopify - Decimal("100")) <= Decimal("0.01")


def test_contributions_sum_to_100(spark):
    total = sum(r.percent_contributions for r in q(spark, "mart_retail_contribution").collect())
    assert abs(total - Decimal("100")) <= Decimal("0.5")


def test_worst_area_rows_come_from_impact(spark):
    impact = {(r.metric, r.value): tuple(r)[2:] for r in q(spark, "mart_impact_by_area").collect()}
    for r in q(spark, "mart_worst_area").collect():
        assert impact[(r.metric, r.value)] == tuple(r)[2:]


def test_funnel_counts_are_consistent(spark):
    t = bind(spark, SF)
    funnel = q(spark, "web_product_funnel")
    tot = funnel.agg(F.sum("views").alias("v"), F.sum("cart_add").alias("c"),
                     F.sum(F.col("abandoned") + F.col("purchases")).alias("ap")).first()
    products = t.page_hierarchy.where(F.col("product_id").isNotNull())
    ev = t.web_events.join(products, "page_id")
    assert tot.v == ev.where(F.col("event_type") == web.VIEW).count()
    assert tot.c == ev.where(F.col("event_type") == web.CART_ADD).count()
    with_add = (ev.where(F.col("event_type") == web.CART_ADD)
                .select("visit_id", "product_id").distinct().count())
    assert tot.ap <= with_add
    cat = q(spark, "web_category_funnel").agg(F.sum("views")).first()[0]
    assert cat == tot.v


def test_visits_are_sessions_of_one_user(spark):
    t = bind(spark, SF)
    e = t.web_events.withColumn("user", F.split("visit_id", "-")[0])
    assert e.groupBy("visit_id").agg(F.countDistinct("user").alias("n")) \
        .where(F.col("n") > 1).count() == 0
    # consecutive events of one visit are at most 12 hours apart
    secs = F.unix_timestamp(F.col("event_time").cast("timestamp"))
    span = e.groupBy("visit_id").agg((F.max(secs) - F.min(secs)).alias("s"))
    n_ev = e.groupBy("visit_id").count()
    bound = span.join(n_ev, "visit_id").where(F.col("s") > (F.col("count") - 1) * 12 * 3600)
    assert bound.count() == 0


def test_reference_and_intent_differ_where_they_should(spark):
    for key in ("loyalty_popular_item", "bank_realloc_percentiles", "bank_month_net",
                "mart_before_after_4w", "web_checkout_no_purchase_pct",
                "web_view_to_purchase"):
        a = sorted(map(repr, q(spark, key).collect()))
        b = sorted(map(repr, q(spark, key + "_intent").collect()))
        assert a != b, key


def test_node_stays_chain(spark):
    """Each non-final stay ends on the start date of the customer's next stay."""
    t = bind(spark, SF)
    n = t.customer_nodes
    open_rows = n.where(F.col("end_date") == F.lit("9999-12-31").cast("date"))
    assert open_rows.count() == n.select("customer_id").distinct().count()
    assert n.where(F.col("end_date") < F.col("start_date")).count() == 0
