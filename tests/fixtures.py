"""Small literal domain tables with hand-computed answers (FIXTURES §3)."""

import datetime as dt
from decimal import Decimal

from casebook.sources.schemas import SCHEMAS
from casebook.sources.tables import LiteralTables

D = dt.date
TS = dt.datetime


def _df(spark, name, data, schema=None):
    return spark.createDataFrame(data, schema or SCHEMAS[name])


def loyalty(spark):
    menu = [(1, "sushi", Decimal("10")), (2, "curry", Decimal("15")), (3, "ramen", Decimal("12"))]
    members = [("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))]
    sales = [("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2),     # tie on first date
             ("A", D(2021, 1, 7), 2), ("A", D(2021, 1, 7), 1),     # orders on the join date
             ("A", D(2021, 1, 10), 3), ("A", D(2021, 1, 11), 3),
             ("B", D(2021, 1, 2), 2), ("B", D(2021, 1, 4), 1),     # join - order = 7 and 5
             ("B", D(2021, 1, 11), 1), ("B", D(2021, 2, 1), 1),    # last one after the cut-off
             ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3),     # not a member
             ("D", D(2021, 1, 5), 9)]                              # product missing in menu
    return LiteralTables(menu=_df(spark, "menu", menu), members=_df(spark, "members", members),
                         sales=_df(spark, "sales", sales))


def bank(spark):
    tx = [(1, D(2020, 1, 5), "deposit", Decimal("100")), (1, D(2020, 1, 5), "purchase", Decimal("30")),
          (1, D(2020, 1, 20), "withdrawal", Decimal("200")),
          (1, D(2020, 2, 3), "deposit", Decimal("500")),
          (1, D(2021, 1, 10), "deposit", Decimal("50")),               # same month, next year
          (2, D(2020, 1, 10), "deposit", Decimal("0")),                # previous balance 0
          (2, D(2020, 2, 15), "deposit", Decimal("10")),
          (3, D(2020, 3, 1), "deposit", Decimal("1000")),
          (3, D(2020, 4, 1), "deposit", Decimal("1"))]
    nodes = [(1, 1, 1, D(2020, 1, 1), D(2020, 1, 2)), (1, 1, 2, D(2020, 1, 3), D(2020, 1, 6)),
             (2, 2, 1, D(2020, 1, 1), D(2020, 1, 1)), (2, 2, 3, D(2020, 1, 2), D(2020, 1, 3)),
             (2, 2, 2, D(2020, 1, 4), D(2020, 1, 6)),
             (3, 3, 1, D(2020, 1, 1), D(2020, 1, 1)), (3, 3, 2, D(2020, 1, 2), D(2020, 1, 3)),
             (3, 3, 3, D(2020, 1, 4), D(2020, 1, 6)), (3, 3, 4, D(2020, 1, 7), D(2020, 1, 16)),
             (4, 3, 5, D(2020, 1, 1), D(9999, 12, 31))]                # open stay
    regions = [(1, "Africa"), (2, "America"), (3, "Asia")]
    return LiteralTables(customer_transactions=_df(spark, "customer_transactions", tx),
                         customer_nodes=_df(spark, "customer_nodes", nodes),
                         regions=_df(spark, "regions", regions))


def mart(spark):
    rows = [("15/6/20", "ASIA", "Retail", "C1", "New", 10, 105),
            ("15/6/20", "ASIA", "retail", "null", "New", 0, 50),       # lower-case platform
            ("15/6/20", "EUROPE", "Shopify", "F2", "Guest", None, 40),
            ("8/6/20", "ASIA", "Retail", "F3", "Existing", 4, 100),
            ("8/6/20", None, "Shopify", "C4", "New", 2, 10),           # region NULL
            ("1/1/50", "ASIA", "Retail", "C1", "New", 1, 1),
            ("31/2/20", "ASIA", "Retail", "C1", "New", 1, 1)]          # invalid date
    return LiteralTables(data_mart=_df(spark, "data_mart", rows))


def web(spark):
    ph = [(12, "Checkout", None, None), (13, "p13", "Fish", 13), (14, "p14", "Fish", 14),
          (15, "p15", "Shellfish", 15), (1, "Home", None, None)]
    t0 = TS(2024, 1, 2, 10, 0)

    def ev(visit, cookie, page, etype, seq, minutes):
        return (visit, cookie, page, etype, seq, t0 + dt.timedelta(minutes=minutes))
    events = [
        # v1: two adds of p13, then a purchase: neither abandoned nor purchased (D25)
        ev("v1", "c1", 13, 1, 1, 0), ev("v1", "c1", 13, 2, 2, 1), ev("v1", "c1", 13, 2, 3, 2),
        ev("v1", "c1", 1, 3, 4, 3),
        # v2: purchase without a checkout view; adds p15 then p14 (seq decides order)
        ev("v2", "c2", 14, 1, 20, 10), ev("v2", "c2", 14, 2, 22, 12),
        ev("v2", "c2", 15, 2, 21, 11), ev("v2", "c2", 1, 3, 23, 13),
        # v3: checkout view, no purchase, impression and click
        ev("v3", "c3", 12, 1, 30, 20), ev("v3", "c3", 1, 4, 31, 21), ev("v3", "c3", 1, 5, 32, 22),
        # v4: p14 added once, not bought (abandoned); starts inside two campaigns
        ev("v4", "c3", 14, 1, 40, 60 * 24 * 4), ev("v4", "c3", 14, 2, 41, 60 * 24 * 4 + 1),
    ]
    users = [(1, "c1"), (2, "c2"), (3, "c3")]
    camps = [("A", TS(2024, 1, 2), TS(2024, 1, 9)), ("B", TS(2024, 1, 6), TS(2024, 1, 7))]
    names = [(1, "Page View"), (2, "Add to Cart"), (3, "Purchase"), (4, "Ad Impression"),
             (5, "Ad Click")]
    return LiteralTables(web_events=_df(spark, "web_events", events),
                         users=_df(spark, "users", users),
                         page_hierarchy=_df(spark, "page_hierarchy", ph),
                         campaign_identifier=_df(spark, "campaign_identifier", camps),
                         event_identifier=_df(spark, "event_identifier", names))
