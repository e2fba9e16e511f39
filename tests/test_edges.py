"""Hand-computed answers on literal edge fixtures."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from casebook.plans import bank, loyalty, mart, web
from casebook.sources.tables import LiteralTables
from tests import fixtures
from tests.conftest import rows

D = dt.date


# ------------------------------------------------------------------ loyalty
def test_loyalty_spend_days_and_first_items(spark):
    t = fixtures.loyalty(spark)
    assert rows(loyalty.total_spend(t)) == [("A", Decimal("74.00")), ("B", Decimal("45.00")),
                                            ("C", Decimal("24.00")), ("D", None)]
    assert rows(loyalty.visit_days(t)) == [("A", 4), ("B", 4), ("C", 1), ("D", 1)]
    assert rows(loyalty.first_items(t)) == [("A", "curry"), ("A", "sushi"), ("B", "curry"),
                                            ("C", "ramen")]
    assert rows(loyalty.top_item(t)) == [(1, "sushi", 5)]


def test_loyalty_popular_reference_vs_intent(spark):   # D1, ties kept
    t = fixtures.loyalty(spark)
    assert rows(loyalty.popular_item(t)) == [("A", "curry"), ("A", "ramen"), ("A", "sushi"),
                                             ("B", "curry"), ("C", "ramen")]
    assert rows(loyalty.popular_item(t, most=True)) == [("A", "curry"), ("A", "ramen"),
                                                        ("A", "sushi"), ("B", "sushi"),
                                                        ("C", "ramen")]


def test_loyalty_around_join(spark):                   # J3: one row per sale line
    t = fixtures.loyalty(spark)
    assert rows(loyalty.first_after_join(t)) == [("A", "curry"), ("A", "sushi"), ("B", "sushi")]
    assert rows(loyalty.last_before_join(t)) == [("A", "curry"), ("A", "sushi"), ("B", "sushi")]
    assert rows(loyalty.spend_before_join(t)) == [("A", 2, Decimal("25.00")),
                                                  ("B", 2, Decimal("25.00"))]


def test_loyalty_points(spark):                        # D2, D3
    t = fixtures.loyalty(spark)
    assert dict(rows(loyalty.points(t))) == {"A": Decimal("940.00"), "B": Decimal("750.00"),
                                             "C": Decimal("240.00")}
    cut = D(2021, 1, 31)
    assert dict(rows(loyalty.points_join_week(t, cutoff=cut))) == {
        "A": Decimal("1240.00"), "B": Decimal("550.00"), "C": Decimal("240.00")}
    assert dict(rows(loyalty.points_join_week(t, cutoff=cut, intent=True))) == {
        "A": Decimal("1330.00"), "B": Decimal("550.00")}


def test_loyalty_member_ranking(spark):                # W8: rank ties, NULL for 'N'
    got = rows(loyalty.member_ranking(fixtures.loyalty(spark)),
               "customer_id", "order_date", "member_status", "ranking")
    a = [r for r in got if r[0] == "A"]
    assert a == [("A", D(2021, 1, 1), "N", None)] * 2 + [("A", D(2021, 1, 7), "Y", 1)] * 2 + \
        [("A", D(2021, 1, 10), "Y", 3), ("A", D(2021, 1, 11), "Y", 4)]
    b = [r[3] for r in got if r[0] == "B"]
    assert b == [None, None, 1, 2]
    assert len(got) == 13


# --------------------------------------------------------------------- bank
def test_bank_running_allocation_uses_range_frame(spark):   # R6
    got = dict((m, v) for m, _, v in rows(bank.alloc_running(fixtures.bank(spark))))
    assert got == {1: Decimal("13.70"), 2: Decimal("8.60"), 3: Decimal("20.50"),
                   4: Decimal("20.52")}


def test_bank_prev_month_and_nets(spark):               # D8, D12
    t = fixtures.bank(spark)
    got = dict((m, v) for m, _, v in rows(bank.alloc_prev_month(t)))
    assert got == {1: Decimal("1.00"), 2: Decimal("1.00"), 3: Decimal("0.50"),
                   4: Decimal("20.50")}
    nets = rows(bank.month_net(t), "customer_id", "month_no", "Mth_end_balance")
    assert nets == [(1, 1, Decimal("-80.00")), (1, 2, Decimal("500.00")), (2, 1, Decimal("0.00")),
                    (2, 2, Decimal("10.00")), (3, 3, Decimal("1000.00")), (3, 4, Decimal("1.00"))]
    closing = rows(bank.month_net(t, intent=True), "customer_id", "year_no", "month_no",
                   "Mth_end_balance")
    assert [r for r in closing if r[0] == 1] == [(1, 2020, 1, Decimal("-130.00")),
                                                 (1, 2020, 2, Decimal("370.00")),
                                                 (1, 2021, 1, Decimal("420.00"))]


def test_bank_growth_guards_zero_previous(spark):       # D10, D11, R9
    t = fixtures.bank(spark)
    assert rows(bank.growth_share(t)) == [(0.25,)]
    assert rows(bank.growth_share(t, intent=True)) == [(0.25,)]


def test_bank_percentiles_and_day_means(spark):         # A18, D4, D5
    t = fixtures.bank(spark)
    p = rows(bank.realloc_percentiles(t))
    assert p == [(1, "Africa", 3.0, 3.7, 3.8), (2, "America", 2.0, 2.7, 2.8),
                 (3, "Asia", 2.5, 6.85, 7.9)]
    assert rows(bank.realloc_days_customer(t)) == [(1, 3), (2, 2), (3, 4)]
    assert rows(bank.realloc_days_all(t)) == [(3,)]
    assert rows(bank.deposit_averages(t)) == [(2, Decimal("554"))]


# --------------------------------------------------------------------- mart
def test_mart_clean_rules(spark):                       # R4, R5, D16, D17
    c = {r.transactions if r.week_date else -1: r
         for r in mart.clean(fixtures.mart(spark)).collect() if r.sales in (105, 50, 1)}
    r = c[10]
    assert (r.week_date, r.week_number, r.month_number, r.calendar_year) == \
        (D(2020, 6, 15), 25, 6, 2020)
    assert (r.age_band, r.demographic, r.segment, r.avg_transactions) == \
        ("Young Adults", "Couples", "C1", 10)
    z = c[0]
    assert (z.age_band, z.demographic, z.segment, z.avg_transactions) == \
        ("Unknown", "unknown", "unknown", None)
    assert c[-1].week_number is None                      # 31/2/20 is not a date
    years = {r.calendar_year for r in mart.clean(fixtures.mart(spark)).collect()}
    assert 1950 in years                                  # 1/1/50 -> 1950


def test_monthly_net_adds_every_other_kind(spark):
    tx = [(1, D(2020, 1, 1), "deposit", Decimal(100)), (1, D(2020, 1, 2), "fee", Decimal(30)),
          (1, D(2020, 1, 3), "Deposit", Decimal(5)), (1, D(2020, 1, 4), None, Decimal(7)),
          (1, D(2020, 1, 5), "WITHDRAWAL", Decimal(40)), (1, D(2020, 1, 6), "purchase", Decimal(2))]
    t = LiteralTables(customer_transactions=spark.createDataFrame(
        tx, "customer_id int, txn_date date, txn_type string, txn_amount decimal(18,2)"))
    assert rows(bank.month_net(t), "Mth_end_balance") == [(Decimal("100.00"),)]
    d = rows(bank._daily_running(t), "running_bal")     # other kinds are nothing here
    assert d[-1] == (Decimal("105.00"),) and min(d) == (Decimal("63.00"),)
    assert ("Deposit", 2) in rows(bank.txn_type_totals(t), "txn_type", "unique_count")
    assert rows(bank.deposit_averages(t)) == [(2, Decimal(105))]


def _one_week(spark, *groups):
    cws = "week_date date, week_number int, month_number int, calendar_year int, region string, " \
        "platform string, age_band string, demographic string, segment string, " \
        "customer_type string, transactions int, sales bigint, avg_transactions bigint"
    return LiteralTables(clean_weekly_sales=spark.createDataFrame(
        [(D(2020, 6, 1), 23, 6, 2020, "ASIA", p, "Retirees", "Couples", "C3", c, n, s, None)
         for p, c, n, s in groups], cws))


def test_zero_totals_give_null(spark):
    t = _one_week(spark, ("Retail", "New", 0, 0))
    assert rows(mart.platform_share(t)) == [(2020, 6, None, None)]
    assert rows(mart.demographic_share(t)) == [(2020, None, None, None)]
    assert rows(mart.retail_contribution(t), "percent_contributions") == [(None,)]
    assert rows(mart.avg_transaction(t)) == [(2020, None, None)]
    assert rows(mart.avg_transaction(t, by_platform=True), "avg_txn") == [(None,)]


def test_ratios_of_empty_tables_are_null(spark):
    empty = LiteralTables(
        customer_transactions=spark.createDataFrame(
            [], "customer_id int, txn_date date, txn_type string, txn_amount decimal(18,2)"),
        customer_nodes=spark.createDataFrame([], "customer_id int"),
        users=spark.createDataFrame([], "user_id int, cookie_id string"))
    assert rows(bank.growth_share(empty)) == [(None,)]
    assert rows(web.cookies_per_user(empty)) == [(None,)]


def test_platforms_that_differ_in_case_are_one(spark):   # R3: one row, in a spelling of the data
    t = _one_week(spark, ("Retail", "VIP", 1, 10), ("retail", "vip", 2, 20), ("SHOPIFY", "B2B", 4, 5))
    assert rows(mart.txn_by_platform(t)) == [("Retail", 3), ("SHOPIFY", 4)]
    got = rows(mart.impact_by_area(t, year=2020), "metric", "value", "sales_before")
    assert ("platform", "Retail", 30) in got and ("customer_type", "VIP", 30) in got
    assert ("customer_type", "B2B", 5) in got and ("platform", "SHOPIFY", 5) in got
    assert rows(mart.avg_transaction(t, by_platform=True), "platform") == [("Retail",), ("SHOPIFY",)]


def test_mixed_case_text_groups_as_one(spark):          # R3
    tx = _bank(spark, (1, D(2020, 1, 5), "Deposit", 100), (1, D(2020, 1, 6), "deposit", 30), (1, D(2020, 1, 7), "PURCHASE", 1))
    assert rows(bank.txn_type_totals(tx)) == [("Deposit", 2, Decimal("130.00")), ("PURCHASE", 1, Decimal("1.00"))]
    base = fixtures.web(spark)
    upper = F.when(F.col("page_id") % 2 == 0, F.upper("product_category")).otherwise(F.col("product_category"))
    mixed = LiteralTables(web_events=base.web_events, users=base.users,
                          page_hierarchy=base.page_hierarchy.withColumn("product_category", upper))
    low = lambda df: sorted((r[0].lower(), *r[1:]) for r in rows(df))
    for plan in (web.category_counts, web.category_funnel):
        assert low(plan(mixed)) == low(plan(base))
    raw = spark.createDataFrame([("1/6/20", "ASIA", "Retail", seg, "New", 1, 10) for seg in ("NULL", "c3", "F1")],
                                "week_date string, region string, platform string, segment string, "
                                "customer_type string, transactions int, sales bigint")
    assert rows(mart.clean(LiteralTables(data_mart=raw)), "segment", "demographic", "age_band") == [
        ("F1", "Families", "Young Adults"), ("c3", "Couples", "Retirees"), ("unknown", "unknown", "Unknown")]


def test_event_and_product_names_ignore_case(spark):
    t = fixtures.web(spark)
    assert rows(web.purchase_pct(t, "purchase")) == rows(web.purchase_pct(t, "PURCHASE"))
    lt = fixtures.loyalty(spark)
    assert rows(loyalty.points(lt, "SUSHI")) == rows(loyalty.points(lt, "sushi"))


def test_results_come_sorted(spark):
    t, b = fixtures.loyalty(spark), fixtures.bank(spark)
    ids = [r.customer_id for r in loyalty.total_spend(t).collect()]
    assert ids == sorted(ids)
    ids = [r.customer_id for r in loyalty.points(t).collect()]
    assert ids == sorted(ids)
    names = [r.region_name for r in bank.nodes_per_region(b).collect()]
    assert names == sorted(names)
    nets = [(r.customer_id, r.month_no) for r in bank.month_net(b).collect()]
    assert nets == sorted(nets)
    kinds = [r.event_type for r in web.events_by_type(fixtures.web(spark)).collect()]
    assert kinds == sorted(kinds)


def test_mart_missing_weeks_not_in_with_null(spark):    # R7
    assert mart.missing_weeks(fixtures.mart(spark)).count() == 0


def test_mart_shares_case_insensitive(spark):           # R3
    got = rows(mart.platform_share(fixtures.mart(spark)))
    assert (2020, 6, Decimal("83.61"), Decimal("16.39")) in got


def test_mart_before_after_and_areas(spark):            # D21, D22, U2
    t = fixtures.mart(spark)
    assert rows(mart.before_after(t)) == [(110, 195, 85, Decimal("77.30"))]
    area = {(m, v): (b, a, p) for m, v, b, a, _, p in
            rows(mart.impact_by_area(t, year=2020))}
    assert area[("region", "ASIA")] == (100, 155, Decimal("55.00"))
    assert area[("region", "EUROPE")] == (None, 40, None)
    assert area[("region", "unknown")] == (10, None, None)
    worst = {m: v for m, v, *_ in rows(mart.worst_area(t, year=2020))}
    assert worst["region"] == "EUROPE"                    # NULL first, tie by value


# ---------------------------------------------------------------------- web
def test_web_checkout_reference_vs_intent(spark):       # D23
    t = fixtures.web(spark)
    assert rows(web.checkout_no_purchase_pct(t)) == [(-100.0,)]
    assert rows(web.checkout_no_purchase_pct(t, intent=True)) == [(100.0,)]
    assert rows(web.purchase_pct(t)) == [(50,)]


def test_web_funnel_single_add_rule(spark):             # D25
    t = fixtures.web(spark)
    assert rows(web.product_funnel(t)) == [(13, "p13", "Fish", 1, 2, 0, 0),
                                           (14, "p14", "Fish", 2, 2, 1, 1),
                                           (15, "p15", "Shellfish", 0, 1, 0, 1)]
    assert rows(web.category_funnel(t)) == [("Fish", 3, 4, 1, 1), ("Shellfish", 0, 1, 0, 1)]


def test_web_leaders_and_rates(spark):                  # D26, D27, O3
    t = fixtures.web(spark)
    assert rows(web.product_leaders(t)) == [("Most Add to Cart", "p13", 2),
                                            ("Most Add to Cart", "p14", 2),
                                            ("Most Purchased", "p14", 2),
                                            ("Most Purchased", "p15", 1),
                                            ("Most Views", "p14", 2)]
    assert ("Most Purchased", "p15", 1) in rows(web.product_leaders(t, intent=True))
    assert rows(web.view_to_purchase(t), "product_name") == [("p15",)]     # NULL rate first
    assert rows(web.view_to_purchase(t, intent=True), "product_name") == [("p14",)]
    assert rows(web.most_abandoned(t), "product_name") == [("p14",)]
    assert rows(web.top_products(t)) == [("p13", 2), ("p14", 1), ("p15", 1)]


def test_web_visit_campaigns(spark):                    # A17, R8
    got = rows(web.visit_campaigns(fixtures.web(spark)), "visit_id", "page_views", "cart_adds",
               "purchase", "impression", "click", "cart_products", "campaign_name")
    assert got == [("v1", 1, 2, 1, 0, 0, "p13, p13", "A"),
                   ("v2", 1, 2, 1, 0, 0, "p15, p14", "A"),
                   ("v3", 1, 0, 0, 1, 1, None, "A"),
                   ("v4", 1, 1, 0, 0, 0, "p14", "A"),
                   ("v4", 1, 1, 0, 0, 0, "p14", "B")]


def test_bank_thirty_day_mean_balance(spark):           # D13 intent
    got = {(y, m): v for y, m, _, v in rows(bank.alloc_avg_balance(fixtures.bank(spark)))}
    assert got == {(2020, 1): Decimal("1.00"), (2020, 2): Decimal("1.00"),
                   (2020, 3): Decimal("0.50"), (2020, 4): Decimal("20.50"),
                   (2021, 1): Decimal("7.90")}


def test_mart_zero_before_and_percent_tie(spark):       # compare_edges: R9, D22
    from casebook.sources.schemas import SCHEMAS
    from casebook.sources.tables import LiteralTables
    rows_ = [("6/4/20", "ASIA", "Retail", "C1", "New", 1, 0),          # week 15: before = 0
             ("22/6/20", "ASIA", "Retail", "C1", "New", 1, 7),         # week 26
             ("6/4/20", "OCEANIA", "Retail", "C1", "New", 1, 100),     # before 100
             ("22/6/20", "OCEANIA", "Retail", "C1", "New", 1, 50),     # after 50: -50 %
             ("6/4/20", "AFRICA", "Shopify", "F2", "Guest", 1, 10),    # before 10
             ("22/6/20", "AFRICA", "Shopify", "F2", "Guest", 1, 5)]    # after 5: -50 % (tie)
    t = LiteralTables(data_mart=spark.createDataFrame(rows_, SCHEMAS["data_mart"]))
    area = {(m, v): (b, a, p) for m, v, b, a, _, p in rows(mart.impact_by_area(t, year=2020))}
    assert area[("region", "ASIA")] == (0, 7, None)          # no division by zero
    assert area[("region", "OCEANIA")] == (100, 50, Decimal("-50.00"))
    worst = {m: (v, p) for m, v, _, _, _, p in rows(mart.worst_area(t, year=2020))}
    assert worst["region"] == ("ASIA", None)                 # NULL percent sorts first
    no_zero = LiteralTables(data_mart=spark.createDataFrame(rows_[2:], SCHEMAS["data_mart"]))
    worst = {m: (v, p) for m, v, _, _, _, p in rows(mart.worst_area(no_zero, year=2020))}
    assert worst["region"] == ("AFRICA", Decimal("-50.00"))  # tie broken by value


def test_web_purchase_without_adds_and_campaign_end_day(spark):   # D24, R8
    from casebook.sources.schemas import SCHEMAS
    from casebook.sources.tables import LiteralTables
    base = fixtures.web(spark)
    extra = spark.createDataFrame(
        [("v5", "c1", 1, 1, 50, dt.datetime(2024, 1, 9, 10, 0)),     # after A's last midnight
         ("v5", "c1", 1, 3, 51, dt.datetime(2024, 1, 9, 10, 5))],    # purchase, no cart adds
        SCHEMAS["web_events"])
    t = LiteralTables(web_events=base.web_events.unionByName(extra), users=base.users,
                      page_hierarchy=base.page_hierarchy,
                      campaign_identifier=base.campaign_identifier,
                      event_identifier=base.event_identifier)
    top = rows(web.top_products(t, n=10))
    assert (None, 1) in top                                   # the NULL product row is kept
    camp = {r[0]: r[1] for r in rows(web.visit_campaigns(t), "visit_id", "campaign_name")
            if r[0] == "v5"}
    assert camp == {"v5": None}


# ------------------------------------------------- previous month, interest, overlaps
def _bank(spark, *tx):
    df = spark.createDataFrame(tx, "customer_id int, txn_date date, txn_type string, txn_amount int")
    return LiteralTables(customer_transactions=df)


def test_bank_previous_calendar_month(spark):           # D12: months without transactions
    t = _bank(spark, (1, D(2020, 1, 5), "deposit", 100), (1, D(2020, 4, 2), "withdrawal", 300),
              (1, D(2020, 6, 1), "deposit", 500), (2, D(2020, 4, 9), "deposit", 50))
    got = {(r[0], r[1]): r[3] for r in rows(bank.alloc_prev_month(t, intent=True))}
    assert got == {(2020, 1): Decimal("0.50"), (2020, 2): Decimal("2.50"), (2020, 3): Decimal("2.50"),
                   (2020, 4): Decimal("3.00"),           # 100 carried to March; a first month
                   (2020, 5): Decimal("0.50"), (2020, 6): Decimal("0.50")}  # -200 twice
    old = {r[0]: r[2] for r in rows(bank.alloc_prev_month(t))}
    assert old[4] == Decimal("3.00") and old[6] == Decimal("0.50") and 5 not in old


def test_bank_interest_grows_day_by_day(spark):         # D15: elapsed days, compounding
    tx = [(1, D(2020, 1, 30), "deposit", 10000), (1, D(2020, 3, 2), "purchase", 4000),
          (1, D(2020, 3, 2), "deposit", 1000), (2, D(2020, 2, 28), "withdrawal", 500), (2, D(2020, 3, 31), "deposit", 900)]
    rate, want = 0.01, {}
    for c in (1, 2):
        own = [x for x in tx if x[0] == c]
        day, bal, earned = own[0][1], 0.0, {}
        while (day.year, day.month) <= (2020, 3):
            gain = bal * rate
            earned[day.month] = earned.get(day.month, 0) + gain
            bal += gain + sum(x[3] if x[2] == "deposit" else -x[3] for x in own if x[1] == day)
            day += dt.timedelta(1)
        for m, e in earned.items():
            want[m] = want.get(m, 0) + max(e, 0) * 0.02
    got = {r[1]: float(r[3]) for r in rows(bank.alloc_interest(_bank(spark, *tx), Decimal(str(rate)), intent=True))}
    assert got == {m: round(v, 2) for m, v in want.items()} and set(got) == {1, 2, 3}


def test_web_visit_in_several_campaigns(spark):         # R8: a row for each, counts unchanged
    base = fixtures.web(spark)
    camps = spark.createDataFrame(
        [("Long", dt.datetime(1990, 1, 1), dt.datetime(9999, 12, 31)), ("Same", dt.datetime(1995, 1, 1), dt.datetime(9999, 1, 1))],
        "campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz")
    base.more = camps
    got = rows(web.visit_campaigns(base, campaigns="more"), "visit_id", "page_views", "campaign_name")
    plain = {(r[0], r[1]) for r in rows(web.visit_campaigns(base), "visit_id", "page_views")}
    assert sorted(got) == sorted((*v, n) for v in plain for n in ("Long", "Same"))
