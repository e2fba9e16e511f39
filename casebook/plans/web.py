"""Clickstream analyses: digital metrics, product funnel, campaigns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casebook.functions import ci_eq, int_div, ratio, year_month
from casebook.operators import bitmaps, count_bitmaps, count_sketches, interval_join, join_back, membership_flag, merge_spellings, \
    ordered_string_agg, sketches, top_k

# Event codes and other reference literals.
VIEW, CART_ADD, PURCHASE, IMPRESSION, CLICK = 1, 2, 3, 4, 5
PURCHASE_EVENT_NAME = "Purchase"
CHECKOUT_PAGE = 12
TOP_PAGES = 3
TOP_PRODUCTS = 3
SINGLE_ADD = 1          # a visit x product counts as abandoned/purchased only at this add count
METRICS = ("Most Views", "Most Add to Cart", "Most Purchased")


def _is(code: int) -> Column:
    return F.col("event_type") == code


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def user_count(t) -> DataFrame:
    return t.users.agg(F.countDistinct("user_id").alias("count_users"))


def cookies_per_user(t) -> DataFrame:
    """Distinct cookies per distinct user, rounded to a whole number."""
    r = ratio(F.countDistinct("cookie_id"), F.countDistinct("user_id"))
    return t.users.agg(F.round(r, 0).cast("int").alias("avg_cookies_per_user"))


def visits_per_month(t) -> DataFrame:
    return (t.web_events.groupBy(year_month("event_time").alias("month"))
            .agg(F.countDistinct("visit_id").alias("unique_visit_count")).orderBy("month"))


def _visit_ids(t) -> DataFrame:
    """(day, visit): the days of each visit, with a whole number for its id.

    The number is that of the visit's first event.  A visit has a row per day,
    so the window sees a count bounded by the calendar.
    """
    days = (t.web_events.groupBy("visit_id", F.to_date("event_time").alias("day"))
            .agg(F.min("sequence_number").alias("_first")))
    first = F.min("_first").over(Window.partitionBy("visit_id"))
    return days.select("day", "visit_id", first.alias("visit"))


def visit_bitmaps(t) -> DataFrame:
    """The visits of each day as bitmaps, to be stored and merged."""
    return bitmaps(_visit_ids(t), ["day"], "visit")


def visit_sketches(t) -> DataFrame:
    """The visits of each day as sketches, to be stored and merged."""
    return sketches(t.web_events.withColumn("day", F.to_date("event_time")), ["day"], "visit_id")


def _periods(stored: DataFrame) -> DataFrame:
    """Every day's row once for its month and once for its year."""
    grains = F.array(*[F.struct(F.lit(g).alias("grain"), F.date_format("day", f).alias("period"))
                       for g, f in (("month", "yyyy-MM"), ("year", "yyyy"))])
    return stored.withColumn("_p", F.explode(grains)).select("*", "_p.*").drop("_p", "day")


def visits_rollup(t) -> DataFrame:
    """Distinct visits per month and per year, from one table of daily bitmaps.

    The table is ``visit_bitmaps`` of ``t`` where it is stored; the events are
    not read then, whatever the periods asked for.  Counts are exact.
    """
    stored = getattr(t, "visit_bitmaps", None)
    days = visit_bitmaps(t) if stored is None else stored
    return (count_bitmaps(_periods(days), ["grain", "period"], "unique_visit_count")
            .orderBy("grain", "period"))


def visits_rollup_approx(t) -> DataFrame:
    """The same from daily sketches (``visit_sketches``); counts are estimates."""
    stored = getattr(t, "visit_sketches", None)
    days = visit_sketches(t) if stored is None else stored
    return (count_sketches(_periods(days), ["grain", "period"], "unique_visit_count")
            .orderBy("grain", "period"))


def events_by_type(t) -> DataFrame:
    return (t.web_events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy("event_type"))


def _visit_flags(t, *flags: tuple[str, Column]) -> DataFrame:
    """One row per visit with ``MAX`` of each 0/1 flag (partial aggregation)."""
    return t.web_events.groupBy("visit_id").agg(*[F.max(c).alias(n) for n, c in flags])


def purchase_pct(t, event_name: str = PURCHASE_EVENT_NAME) -> DataFrame:
    """Visits with a purchase event x 100 / all visits, integer division.

    The purchase codes come from the event-name table, each once; Spark
    decides from its measured size whether to broadcast it.  Each visit
    becomes one flag row, then one global sum.
    """
    codes = (t.event_identifier.where(ci_eq("event_name", event_name))
             .select("event_type").distinct().withColumn("_hit", F.lit(1)))
    e = t.web_events.join(codes, "event_type", "left")
    v = e.groupBy("visit_id").agg(F.max(F.coalesce("_hit", F.lit(0))).alias("p"))
    return v.agg(int_div(F.sum("p") * 100, F.count(F.lit(1))).alias("percentage_purchase"))


def checkout_no_purchase_pct(t, intent: bool = False,
                             checkout_page: int = CHECKOUT_PAGE) -> DataFrame:
    """Percent of checkout-viewing visits without a purchase.

    Reference: ``100 * (1 - purchasing visits / checkout visits)``, which
    counts purchases even without a checkout view.  Intent: visits that
    viewed the checkout and did not purchase, over checkout visits.
    """
    v = _visit_flags(t, ("checkout", _flag(_is(VIEW) & (F.col("page_id") == checkout_page))),
                     ("purchase", _flag(_is(PURCHASE))))
    c = F.sum("checkout")
    if intent:
        x = F.lit(100.0) * ratio(F.sum(_flag((F.col("checkout") == 1)
                                             & (F.col("purchase") == 0))), c)
    else:
        x = F.lit(100.0) * (F.lit(1.0) - ratio(F.sum("purchase"), c))
    return v.agg(F.round(x, 2).alias("percentage_checkout_view_with_no_purchase"))


def top_pages(t, n: int = TOP_PAGES) -> DataFrame:
    """Top pages by views (ties broken by page name)."""
    views = (t.web_events.where(_is(VIEW)).join(t.page_hierarchy, "page_id")
             .groupBy("page_name").agg(F.count(F.lit(1)).alias("page_view")))
    views = merge_spellings(views, ["page_name"], sums=["page_view"])
    return top_k(views, n, F.desc("page_view"), F.asc("page_name"))


def category_counts(t) -> DataFrame:
    """Cart adds and views per product category."""
    g = (t.web_events.join(t.page_hierarchy, "page_id")
         .where(F.col("product_category").isNotNull())
         .groupBy("product_category")
         .agg(F.count(F.when(_is(CART_ADD), 1)).alias("cart_add_count"),
              F.count(F.when(_is(VIEW), 1)).alias("view_count")))
    return (merge_spellings(g, ["product_category"], sums=["cart_add_count", "view_count"])
            .orderBy("product_category"))


def top_products(t, n: int = TOP_PRODUCTS) -> DataFrame:
    """Products by cart adds inside purchasing visits, top n.

    Purchasing visits left-joined to their product cart adds; a purchasing
    visit without adds forms one row with a NULL product.  Adds are first
    counted per (visit, product), so the join meets at most one row per
    product of a visit however long the visit is.
    """
    pv = t.web_events.where(_is(PURCHASE)).select("visit_id").distinct()
    products = t.page_hierarchy.where(F.col("product_id").isNotNull())
    adds = (t.web_events.where(_is(CART_ADD)).join(products, "page_id")
            .groupBy("visit_id", "page_name").agg(F.count(F.lit(1)).alias("_n")))
    q = (pv.join(adds, "visit_id", "left")
         .groupBy(F.col("page_name").alias("Product"))
         .agg(F.sum(F.coalesce("_n", F.lit(1))).alias("Quantity_purchased")))
    return top_k(q, n, F.desc("Quantity_purchased"), F.asc_nulls_first("Product"))


def _visit_product(t) -> DataFrame:
    """Per (visit, product page): views, cart adds, and the visit's purchase flag."""
    products = t.page_hierarchy.where(F.col("product_id").isNotNull())
    ppe = (t.web_events.join(products, "page_id")
           .groupBy("visit_id", "product_id", F.col("page_name").alias("product_name"),
                    "product_category")
           .agg(F.sum(_flag(_is(VIEW))).alias("page_view"),
                F.sum(_flag(_is(CART_ADD))).alias("cart_add")))
    purchases = t.web_events.where(_is(PURCHASE)).select("visit_id")
    return membership_flag(ppe, purchases, "visit_id", "purchase")


def _funnel(df: DataFrame, keys: list[str], single_add: int) -> DataFrame:
    one = F.col("cart_add") == single_add
    return (df.groupBy(*keys)
            .agg(F.sum("page_view").cast("bigint").alias("views"),
                 F.sum("cart_add").cast("bigint").alias("cart_add"),
                 F.sum(_flag(one & (F.col("purchase") == 0))).cast("bigint").alias("abandoned"),
                 F.sum(_flag(one & (F.col("purchase") == 1))).cast("bigint").alias("purchases")))


def product_funnel(t, single_add: int = SINGLE_ADD) -> DataFrame:
    """``product_info``: views, cart adds, abandoned and purchased per product.

    A visit x product is abandoned (or purchased) only when it has exactly
    ``single_add`` cart adds, as in the reference.  Materialise it with
    ``casebook.sources.materialize`` when several reports read it.
    """
    return _funnel(_visit_product(t), ["product_id", "product_name", "product_category"],
                   single_add)


def category_funnel(t, single_add: int = SINGLE_ADD) -> DataFrame:
    """The product funnel per product category."""
    g = _funnel(_visit_product(t), ["product_category"], single_add)
    return merge_spellings(g, ["product_category"], sums=["views", "cart_add", "abandoned", "purchases"])


def _info(t) -> DataFrame:
    pi = getattr(t, "product_info", None)
    return pi if pi is not None else product_funnel(t)


def product_leaders(t, intent: bool = False) -> DataFrame:
    """Products at the maximum of views, cart adds and purchases (ties kept).

    The reference reports the cart adds as the value of "Most Purchased";
    ``intent=True`` reports the purchases.  The three metrics become rows
    of one frame, their maxima a 3-row aggregate, and the match an
    equi-join on (metric, value).
    """
    pi = _info(t)
    purchased_value = "purchases" if intent else "cart_add"
    spec = [(METRICS[0], "views", "views"), (METRICS[1], "cart_add", "cart_add"),
            (METRICS[2], "purchases", purchased_value)]
    long = pi.select("product_name", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(r).alias("_rank_value"),
                 F.col(v).alias("value")) for m, r, v in spec])))
    mx = long.groupBy("metric").agg(F.max("_rank_value").alias("_rank_value"))
    return (long.join(F.broadcast(mx), ["metric", "_rank_value"])  # three rows
            .select("metric", "product_name", "value"))


def most_abandoned(t) -> DataFrame:
    """Product with the highest abandoned / cart-add rate (ties: product_id)."""
    pi = _info(t)
    rate = F.round(ratio("abandoned", "cart_add"), 2).alias("abandoned_rate")
    top = top_k(pi.select("product_id", "product_name", "product_category", "abandoned",
                          "cart_add", rate),
                1, F.desc_nulls_last("abandoned_rate"), F.asc("product_id"))
    return top.drop("product_id")


def view_to_purchase(t, intent: bool = False) -> DataFrame:
    """Product at the end of the purchases / views ranking.

    The reference sorts ascending (lowest rate); ``intent=True`` sorts
    descending, as its question asks.
    """
    pi = _info(t)
    rate = F.round(ratio("purchases", "views"), 2).alias("view_to_purchase_rate")
    order = F.desc_nulls_last("view_to_purchase_rate") if intent \
        else F.asc_nulls_first("view_to_purchase_rate")
    top = top_k(pi.select("product_id", "product_name", "product_category", "abandoned",
                          "cart_add", rate), 1, order, F.asc("product_id"))
    return top.drop("product_id")


def view_to_cart_rate(t) -> DataFrame:
    return _info(t).agg(F.round(F.avg(ratio("cart_add", "views")), 4)
                        .alias("avg_view_to_cart_conversion"))


def cart_to_purchase_rate(t) -> DataFrame:
    """Mean purchase / cart-add rate (the reference reuses the previous alias)."""
    return _info(t).agg(F.round(F.avg(ratio("purchases", "cart_add")), 4)
                        .alias("avg_view_to_cart_conversion"))


def visit_campaigns(t, campaigns: str = "campaign_identifier") -> DataFrame:
    """One row per (user, visit, campaign) with counts, cart products and campaign.

    Visits are aggregated first, with plain counts in a hash aggregate; the
    ordered product list is built from the cart adds alone.  The campaign is
    then looked up once per visit by its start time in the dyadic blocks of the
    campaigns' days, so no visit is compared with every campaign and campaigns
    may be many, long, open or overlap.  A visit within several campaigns has a
    row for each, with the same counts; one within none has a NULL campaign.
    This equals the reference's double range join when campaigns do not overlap.
    ``campaigns`` names the table of campaigns.
    """
    ev = t.users.join(t.web_events, "cookie_id")
    products = t.page_hierarchy.where(F.col("product_id").isNotNull())
    carts = (ev.where(_is(CART_ADD)).join(products.select("page_id", "page_name"), "page_id")
             .groupBy("user_id", "visit_id")
             .agg(ordered_string_agg("page_name", "sequence_number").alias("cart_products")))
    vs = (ev.groupBy("user_id", "visit_id")
          .agg(F.min("event_time").alias("visit_start_time"),
               F.count(F.when(_is(VIEW), 1)).alias("page_views"),
               F.count(F.when(_is(CART_ADD), 1)).alias("cart_adds"),
               F.max(_flag(_is(PURCHASE))).alias("purchase"),
               F.count(F.when(_is(IMPRESSION), 1)).alias("impression"),
               F.count(F.when(_is(CLICK), 1)).alias("click")))
    camp = getattr(t, campaigns).select("campaign_name", "start_date", "end_date")
    key = ["user_id", "visit_id"]
    found = interval_join(vs, "visit_start_time", camp, "start_date", "end_date", key)
    return (join_back(found, carts, key).select(*vs.columns, "cart_products", "campaign_name")
            .orderBy("user_id"))
