"""Query keys -> callables ``(spark, sf_dir) -> DataFrame``.

Parameters are bound to the values that fit the test data (FIXTURES §2.3);
the functions' own defaults are the reference literals.  Values marked
``Bound`` fit the test binding only: ``on_tables`` runs a key over any
domain tables (e.g. a catalog database) with those left at the reference
literals.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casebook.plans import bank, loyalty, mart, upkeep, web
from casebook.sources import bind

# Parameter values for the bound test data.
BOUND_BONUS_PRODUCT = "blue anvil"
BOUND_POINTS_CUTOFF = dt.date(1998, 12, 31)
BOUND_CHANGE_DATE = dt.date(1998, 6, 15)
BOUND_CHANGE_YEAR = 1998
BOUND_MISSING_WEEKS_YEAR = 2001
BOUND_DELTA_MONDAYS = (dt.date(1999, 1, 4), dt.date(2000, 1, 3), dt.date(2001, 1, 1))


class Bound:
    """A parameter value that fits the bound test data only."""

    def __init__(self, value):
        self.value = value


def _q(fn, **params) -> Callable[[SparkSession, str], DataFrame]:
    values = {k: (v.value if isinstance(v, Bound) else v) for k, v in params.items()}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bind(spark, sf_dir), **values)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    run.analysis = fn
    run.params = values
    run.portable_params = {k: v for k, v in params.items() if not isinstance(v, Bound)}
    return run


def on_tables(key: str, tables) -> DataFrame:
    """Run ``key`` over any domain tables with the reference's parameter values."""
    q = QUERIES[key]
    return q.analysis(tables, **q.portable_params)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # loyalty
    "scan_loyalty_sources": _q(loyalty.scan_sources),
    "loyalty_total_spend": _q(loyalty.total_spend),
    "loyalty_visit_days": _q(loyalty.visit_days),
    "loyalty_first_items": _q(loyalty.first_items),
    "loyalty_top_item": _q(loyalty.top_item),
    "loyalty_popular_item": _q(loyalty.popular_item),
    "loyalty_popular_item_intent": _q(loyalty.popular_item, most=True),
    "loyalty_first_after_join": _q(loyalty.first_after_join),
    "loyalty_last_before_join": _q(loyalty.last_before_join),
    "loyalty_spend_before_join": _q(loyalty.spend_before_join),
    "loyalty_points": _q(loyalty.points, bonus_product=Bound(BOUND_BONUS_PRODUCT)),
    "loyalty_points_join_week": _q(loyalty.points_join_week,
                                   bonus_product=Bound(BOUND_BONUS_PRODUCT),
                                   cutoff=Bound(BOUND_POINTS_CUTOFF)),
    "loyalty_points_join_week_intent": _q(loyalty.points_join_week,
                                          bonus_product=Bound(BOUND_BONUS_PRODUCT),
                                          cutoff=Bound(BOUND_POINTS_CUTOFF), intent=True),
    "loyalty_member_ranking": _q(loyalty.member_ranking),
    # bank
    "scan_bank_sources": _q(bank.scan_sources),
    "bank_node_count": _q(bank.node_count),
    "bank_nodes_per_region": _q(bank.nodes_per_region),
    "bank_customers_per_region": _q(bank.customers_per_region),
    "bank_realloc_days_customer": _q(bank.realloc_days_customer),
    "bank_realloc_days_all": _q(bank.realloc_days_all),
    "bank_realloc_percentiles": _q(bank.realloc_percentiles),
    "bank_realloc_percentiles_intent": _q(bank.realloc_percentiles,
                                          percentiles=bank.PERCENTILES_INTENT),
    "bank_txn_type_totals": _q(bank.txn_type_totals),
    "bank_deposit_averages": _q(bank.deposit_averages),
    "bank_active_customers_month": _q(bank.active_customers_month),
    "bank_active_customers_month_intent": _q(bank.active_customers_month, intent=True),
    "bank_month_net": _q(bank.month_net),
    "bank_month_net_intent": _q(bank.month_net, intent=True),
    "bank_growth_share": _q(bank.growth_share),
    "bank_growth_share_intent": _q(bank.growth_share, intent=True),
    "bank_alloc_prev_month": _q(bank.alloc_prev_month),
    "bank_alloc_prev_month_intent": _q(bank.alloc_prev_month, intent=True),
    "bank_alloc_avg_deposit": _q(bank.alloc_avg_deposit),
    "bank_alloc_avg_deposit_intent": _q(bank.alloc_avg_balance),
    "bank_alloc_running": _q(bank.alloc_running),
    "bank_alloc_interest": _q(bank.alloc_interest),
    "bank_alloc_interest_intent": _q(bank.alloc_interest, intent=True),
    # mart
    "mart_clean": _q(mart.clean),
    "mart_weekday": _q(mart.weekday),
    "mart_missing_weeks": _q(mart.missing_weeks),
    "mart_missing_weeks_year": _q(mart.missing_weeks, year=Bound(BOUND_MISSING_WEEKS_YEAR)),
    "mart_txn_by_year": _q(mart.txn_by_year),
    "mart_sales_region_month": _q(mart.sales_region_month),
    "mart_txn_by_platform": _q(mart.txn_by_platform),
    "mart_platform_share": _q(mart.platform_share),
    "mart_demographic_share": _q(mart.demographic_share),
    "mart_retail_contribution": _q(mart.retail_contribution),
    "mart_avg_transaction": _q(mart.avg_transaction),
    "mart_avg_transaction_intent": _q(mart.avg_transaction, by_platform=True),
    "mart_change_week": _q(mart.change_week, change_date=Bound(BOUND_CHANGE_DATE),
                           year=Bound(BOUND_CHANGE_YEAR)),
    "mart_before_after_4w": _q(mart.before_after, weeks=mart.WEEKS_4),
    "mart_before_after_4w_intent": _q(mart.before_after, weeks=mart.WEEKS_4,
                                      year=Bound(BOUND_CHANGE_YEAR)),
    "mart_before_after_12w": _q(mart.before_after, weeks=mart.WEEKS_12,
                                year=Bound(BOUND_CHANGE_YEAR), diff_name="sales_diff_12w",
                                pct_name="percent_diff_12w"),
    "mart_before_after_12w_intent": _q(mart.before_after, weeks=mart.WEEKS_12_INTENT,
                                       year=Bound(BOUND_CHANGE_YEAR), diff_name="sales_diff_12w",
                                       pct_name="percent_diff_12w"),
    "mart_before_after_4w_years": _q(mart.before_after_years, weeks=mart.WEEKS_4),
    "mart_before_after_12w_years": _q(mart.before_after_years, weeks=mart.WEEKS_12),
    "mart_before_after_changes": _q(mart.before_after_changes),
    "mart_clean_incremental": _q(upkeep.weekly_in_deltas, mondays=Bound(BOUND_DELTA_MONDAYS)),
    "mart_impact_by_area": _q(mart.impact_by_area, year=Bound(BOUND_CHANGE_YEAR)),
    "mart_worst_area": _q(mart.worst_area, year=Bound(BOUND_CHANGE_YEAR)),
    # web
    "web_user_count": _q(web.user_count),
    "web_cookies_per_user": _q(web.cookies_per_user),
    "web_visits_per_month": _q(web.visits_per_month),
    "web_visits_rollup": _q(web.visits_rollup),
    "web_visits_rollup_approx": _q(web.visits_rollup_approx),
    "web_events_by_type": _q(web.events_by_type),
    "web_purchase_pct": _q(web.purchase_pct),
    "web_checkout_no_purchase_pct": _q(web.checkout_no_purchase_pct),
    "web_checkout_no_purchase_pct_intent": _q(web.checkout_no_purchase_pct, intent=True),
    "web_top_pages": _q(web.top_pages),
    "web_category_counts": _q(web.category_counts),
    "web_top_products": _q(web.top_products),
    "web_product_funnel": _q(web.product_funnel),
    "web_category_funnel": _q(web.category_funnel),
    "web_product_leaders": _q(web.product_leaders),
    "web_product_leaders_intent": _q(web.product_leaders, intent=True),
    "web_most_abandoned": _q(web.most_abandoned),
    "web_view_to_purchase": _q(web.view_to_purchase),
    "web_view_to_purchase_intent": _q(web.view_to_purchase, intent=True),
    "web_view_to_cart_rate": _q(web.view_to_cart_rate),
    "web_cart_to_purchase_rate": _q(web.cart_to_purchase_rate),
    "web_visit_campaigns": _q(web.visit_campaigns),
    "web_visit_campaigns_overlap": _q(web.visit_campaigns, campaigns=Bound("overlapping_campaigns")),
}
