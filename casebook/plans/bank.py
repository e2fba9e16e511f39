"""Bank analyses over customer_nodes, regions and customer_transactions."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from casebook.functions import ci_eq, days_between, int_avg, month_name, ratio, signed_amount
from casebook.operators import fill_months, merge_spellings, running_total_by_day
from casebook.plans.common import MONEY, row_counts

# Reference literals.
OPEN_END = dt.date(9999, 12, 31)
PERCENTILES = {"median_day": 0.5, "p80th_day": 0.85, "p90th_day": 0.9}
PERCENTILES_INTENT = {"median_day": 0.5, "p80th_day": 0.8, "p95th_day": 0.95}
GROWTH_THRESHOLD = Decimal("0.05")
GB_BASE = Decimal("0.5")            # allocation when the balance is missing or negative
GB_PER_UNIT = Decimal("0.02")       # (balance / 100.0) * 2
DAILY_INTEREST = Decimal("0.000164")
PERCENTILE_DIGITS = 4
RATE_EPOCH = dt.date(2000, 1, 1)    # the day that growing amounts are counted back to


def scan_sources(t) -> DataFrame:
    """Row count of each source table."""
    return row_counts(customer_nodes=t.customer_nodes,
                      customer_transactions=t.customer_transactions, regions=t.regions)


def node_count(t) -> DataFrame:
    """Distinct nodes overall."""
    return t.customer_nodes.agg(F.countDistinct("node_id").alias("number_of_nodes"))


def nodes_per_region(t) -> DataFrame:
    """Distinct nodes per region name.

    Distinct (region, node) pairs are formed before the join, so only that
    small set meets the region table.
    """
    pairs = t.customer_nodes.select("region_id", "node_id").distinct()
    return (pairs.join(t.regions, "region_id")
            .groupBy("region_name")
            .agg(F.countDistinct("node_id").alias("nb_of_nodes_region"))
            .orderBy("region_name"))


def customers_per_region(t) -> DataFrame:
    """Distinct customers per region (counted before joining the names)."""
    per = (t.customer_nodes.groupBy("region_id")
           .agg(F.countDistinct("customer_id").alias("nb_of_cus_region")))
    return (per.join(t.regions, "region_id")
            .select("region_id", "region_name", "nb_of_cus_region")
            .orderBy("region_id"))


def _closed_stays(t) -> DataFrame:
    return (t.customer_nodes.where(F.col("end_date") != F.lit(OPEN_END))
            .withColumn("_days", days_between("start_date", "end_date") + 1))


def realloc_days_customer(t) -> DataFrame:
    """Mean inclusive days per closed node stay, per customer (integer mean)."""
    return (_closed_stays(t).groupBy("customer_id")
            .agg(int_avg("_days").alias("Avg_Day_to_Reallocate")))


def realloc_days_all(t) -> DataFrame:
    """Mean inclusive days per closed node stay over all customers."""
    return _closed_stays(t).agg(int_avg("_days").alias("Avg_Day_to_Reallocate"))


def realloc_percentiles(t, percentiles: dict[str, float] | None = None) -> DataFrame:
    """Exact interpolated percentiles of stay days per region.

    Stays are first counted per (region, days) — an ordinary distributed
    aggregation — and the percentile is then taken over that histogram with
    its counts as frequencies.  The final per-region step sees one row per
    distinct stay length (bounded by the calendar), however many stays a
    region has.
    """
    ps = percentiles or PERCENTILES
    hist = (_closed_stays(t).groupBy("region_id", "_days")
            .agg(F.count(F.lit(1)).alias("_n")))
    aggs = [F.round(F.percentile("_days", F.lit(p), F.col("_n")), PERCENTILE_DIGITS).alias(name)
            for name, p in ps.items()]
    per = hist.groupBy("region_id").agg(*aggs)
    return per.join(t.regions, "region_id").select("region_id", "region_name", *ps)


def txn_type_totals(t) -> DataFrame:
    """Row count and amount per transaction type."""
    g = (t.customer_transactions.groupBy("txn_type")
         .agg(F.count("txn_type").alias("unique_count"), F.sum("txn_amount").alias("total_amount")))
    return (merge_spellings(g, ["txn_type"], sums=["unique_count", "total_amount"])
            .withColumn("total_amount", F.col("total_amount").cast(MONEY)))


def deposit_averages(t) -> DataFrame:
    """Mean per-customer deposit count (integer mean) and amount (rounded)."""
    per = (t.customer_transactions.where(ci_eq("txn_type", "deposit"))
           .groupBy("customer_id")
           .agg(F.count("txn_type").alias("total_txn"),
                F.sum("txn_amount").alias("amount_transacted")))
    mean_amount = F.sum("amount_transacted") / F.count("amount_transacted")
    return per.agg(int_avg("total_txn").alias("avg_total_txn"),
                   F.round(mean_amount, 0).cast("decimal(38,0)").alias("avg_amount_transacted"))


def _month_keys(d: str, with_year: bool) -> list[Column]:
    keys = [F.month(d).cast("int").alias("month_no"), month_name(d).alias("month_name")]
    return ([F.year(d).cast("int").alias("year_no")] + keys) if with_year else keys


def _kind_count(kind: str) -> Column:
    return F.sum(F.when(ci_eq("txn_type", kind), 1).otherwise(0))


def active_customers_month(t, intent: bool = False) -> DataFrame:
    """Customers per month passing the activity test.

    Reference: more than one deposit, withdrawal *and* purchase in the month
    (months of all years pooled).  Intent: more than one deposit and at least
    one purchase or withdrawal, per calendar month.  Each customer appears
    once per month group, so the distinct count is a plain count.
    """
    keys = _month_keys("txn_date", with_year=intent)
    per = (t.customer_transactions.groupBy("customer_id", *keys)
           .agg(_kind_count("deposit").alias("d"), _kind_count("withdrawal").alias("w"),
                _kind_count("purchase").alias("p")))
    if intent:
        ok = (F.col("d") > 1) & ((F.col("p") >= 1) | (F.col("w") >= 1))
        group = ["year_no", "month_no", "month_name"]
    else:
        ok = (F.col("d") > 1) & (F.col("w") > 1) & (F.col("p") > 1)
        group = ["month_no", "month_name"]
    return (per.where(ok).groupBy(*group).agg(F.count(F.lit(1)).alias("active_cus"))
            .orderBy(*group))


def _signed() -> Column:
    """Deposits in, withdrawals and purchases out, any other kind nothing (running balances)."""
    return signed_amount("txn_type", "txn_amount")


def _signed_net() -> Column:
    """Withdrawals and purchases out, every other kind in (monthly nets)."""
    return signed_amount("txn_type", "txn_amount", other="txn_amount")


def _monthly_net(t, with_year: bool) -> DataFrame:
    return (t.customer_transactions
            .groupBy("customer_id", *_month_keys("txn_date", with_year))
            .agg(F.sum(_signed_net()).alias("net")))


def _closing(monthly: DataFrame) -> DataFrame:
    """Running sum of monthly nets per customer (closing balance).

    The window runs over customer-months, a count bounded by the calendar.
    """
    w = (Window.partitionBy("customer_id").orderBy("year_no", "month_no")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return monthly.withColumn("net", F.sum("net").over(w))


def month_net(t, intent: bool = False) -> DataFrame:
    """Per customer and month: net movement (reference) or closing balance (intent)."""
    m = _monthly_net(t, with_year=intent)
    if intent:
        m = _closing(m)
    cols = ["customer_id"] + (["year_no"] if intent else []) + ["month_no"]
    return m.select(*cols, F.col("month_name").alias("month_num"),
                    F.col("net").cast(MONEY).alias("Mth_end_balance")).orderBy(*cols)


def growth_share(t, intent: bool = False, threshold: Decimal = GROWTH_THRESHOLD) -> DataFrame:
    """Share of customers with a month-on-month balance rise above ``threshold``.

    The rise is ``(bal - prev) / |prev|`` against the previous present month
    (LAG); a zero previous balance gives no ratio.  It is tested as
    ``bal - prev > threshold * |prev|``, exact in decimals.  The denominator
    is the distinct customers of customer_nodes, a one-row scalar subquery.
    Reference: monthly nets with months pooled; intent: closing balances by
    calendar month.
    """
    m = _monthly_net(t, with_year=intent)
    order = ["month_no"]
    if intent:
        m = _closing(m)
        order = ["year_no", "month_no"]
    prev = F.lag("net").over(Window.partitionBy("customer_id").orderBy(*order))
    m = m.withColumn("_prev", prev)
    rise = (F.col("_prev").isNotNull() & (F.col("_prev") != 0)
            & ((F.col("net") - F.col("_prev")) > F.lit(threshold) * F.abs(F.col("_prev"))))
    num = m.where(rise).agg(F.countDistinct("customer_id").alias("_num"))
    den = t.customer_nodes.agg(F.countDistinct("customer_id"))
    return num.select(F.round(ratio(F.col("_num"), den.scalar()), 6).alias("growth"))


def _gb(balance: Column) -> Column:
    return (F.when(balance.isNull() | (balance < 0), F.lit(GB_BASE))
            .otherwise(balance * F.lit(GB_PER_UNIT) + F.lit(GB_BASE)))


def _sum_gb(df: DataFrame, gb: Column) -> DataFrame:
    return (df.groupBy("month_no", "month_name")
            .agg(F.sum(gb).cast(MONEY).alias("total_data_allocated_gb"))
            .orderBy("month_no"))


def _calendar_month(day: str) -> list[Column]:
    return [F.year(day).cast("int").alias("year_no"), *_month_keys(day, False)]


def alloc_prev_month(t, intent: bool = False) -> DataFrame:
    """Storage per month from the previous month's money.

    0.5 GB when there is no previous month or it is negative, else
    ``prev / 100 * 2 + 0.5``; summed over customers per month.  Reference: the
    net of the previous month that has transactions (LAG), months of all years
    pooled.  Intent: the balance at the end of the calendar month before, per
    calendar month.  A customer has every month from the first to the last
    transaction then; one without transactions keeps the balance before it.
    """
    if intent:
        nets = (t.customer_transactions.groupBy("customer_id", F.trunc("txn_date", "month").alias("month"))
                .agg(F.sum(_signed_net()).alias("net")))
        so_far = (Window.partitionBy("customer_id").orderBy("month")
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        spine = fill_months(nets.withColumn("balance", F.sum("net").over(so_far)), "customer_id", "month", ["balance"])
        prev = F.lag("balance").over(Window.partitionBy("customer_id").orderBy("month"))
        return (spine.withColumn("_prev", prev).groupBy(*_calendar_month("month"))
                .agg(F.sum(_gb(F.col("_prev"))).cast(MONEY).alias("total_data_allocated_gb"))
                .orderBy("year_no", "month_no"))
    m = _monthly_net(t, with_year=False)
    prev = F.lag("net").over(Window.partitionBy("customer_id").orderBy("month_no"))
    return _sum_gb(m.withColumn("_prev", prev), _gb(F.col("_prev")))


def alloc_avg_deposit(t) -> DataFrame:
    """The same rule on the previous present month's mean deposit amount."""
    m = (t.customer_transactions.where(ci_eq("txn_type", "deposit"))
         .groupBy("customer_id", *_month_keys("txn_date", False))
         .agg(F.avg("txn_amount").alias("avg_bal")))
    prev = F.lag("avg_bal").over(Window.partitionBy("customer_id").orderBy("month_no"))
    return _sum_gb(m.withColumn("_prev", prev), _gb(F.col("_prev")))


def alloc_avg_balance(t, window_days: int = 30) -> DataFrame:
    """Storage per calendar month from the mean balance of the previous days.

    The question behind the reference's option 2: allocate on "the average
    amount of money kept in the account in the previous 30 days".  For each
    customer and each month with transactions, the window is the
    ``window_days`` days before the month's first day, and the mean is taken
    over the end-of-day balance of each window day (0 before the first
    transaction).  A customer with no transaction before the month gets the
    0.5 GB base, as a missing previous month does.

    No per-customer window over raw rows is needed.  The sum of the window's
    daily balances is ``window_days x opening balance`` plus, for every
    balance change inside the window, ``change x days from it to the month
    start``.  The opening balance is an as-of lookup done by one window over
    (customer, day) rows and month anchors, bounded by the calendar.  Each
    change day can fall only into the windows of the next one or two month
    starts, so it is joined to at most two customer-months.
    """
    tx = t.customer_transactions
    daily = (tx.groupBy("customer_id", F.col("txn_date").alias("day"))
             .agg(F.sum(_signed()).alias("day_total")))
    upto = (Window.partitionBy("customer_id").orderBy("day")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    daily = daily.withColumn("bal", F.sum("day_total").over(upto))
    months = tx.select("customer_id", F.trunc("txn_date", "month").alias("s")).distinct()

    # Opening balance: the balance as of the day before the window starts.
    anchors = months.select("customer_id", F.date_sub("s", window_days + 1).alias("day"),
                            F.lit(None).cast(daily.schema["bal"].dataType).alias("bal"),
                            F.lit(1).alias("_kind"), "s")
    changes = daily.select("customer_id", "day", "bal", F.lit(0).alias("_kind"),
                           F.lit(None).cast("date").alias("s"))
    asof = (Window.partitionBy("customer_id").orderBy("day", "_kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    opening = (changes.unionByName(anchors)
               .withColumn("_b0", F.last("bal", ignorenulls=True).over(asof))
               .where(F.col("_kind") == 1).select("customer_id", "s", "_b0"))

    # Changes inside the window of month start s: s - window_days <= day < s.
    first = F.trunc("day", "month")
    starts = F.array(*[F.add_months(first, k) for k in range(1, window_days // 28 + 2)])
    inside = (daily.select("customer_id", "day", "day_total", F.explode(starts).alias("s"))
              .where(F.col("s") <= F.date_add("day", window_days))
              .join(months, ["customer_id", "s"])
              .groupBy("customer_id", "s")
              .agg(F.sum(F.col("day_total") * F.datediff("s", "day")).alias("_inside")))

    per = months.join(opening, ["customer_id", "s"], "left").join(inside, ["customer_id", "s"],
                                                                  "left")
    has_prior = F.col("_b0").isNotNull() | F.col("_inside").isNotNull()
    total = (F.coalesce(F.col("_b0"), F.lit(0)) * window_days
             + F.coalesce(F.col("_inside"), F.lit(0)))
    counted = F.when(has_prior & (total >= 0), total)
    # sum(total / days * 0.02 + 0.5) = sum(total) / (days * 50) + 0.5 * customers
    gb = (F.coalesce(F.sum(counted), F.lit(0)).cast("double") / float(window_days * 50)
          + F.lit(0.5) * F.count(F.lit(1)))
    return (per.groupBy(F.year("s").cast("int").alias("year_no"),
                        F.month("s").cast("int").alias("month_no"),
                        month_name("s").alias("month_name"))
            .agg(F.round(gb, 2).cast(MONEY).alias("total_data_allocated_gb"))
            .orderBy("year_no", "month_no"))


def _daily_running(t) -> DataFrame:
    days = running_total_by_day(t.customer_transactions, "customer_id", "txn_date",
                                _signed(), "running_bal")
    return days.select("*", *_month_keys("txn_date", False))


def alloc_running(t) -> DataFrame:
    """Storage summed over every transaction row from the running balance.

    The running balance uses the default RANGE frame (same-day rows share
    it), so it is computed once per customer-day and weighted by the day's
    row count.
    """
    d = _daily_running(t)
    gb = F.when(F.col("running_bal") < 0, F.lit(GB_BASE)) \
        .otherwise(F.col("running_bal") * F.lit(GB_PER_UNIT) + F.lit(GB_BASE))
    return _sum_gb(d, F.col("n_rows") * gb)


def alloc_interest(t, daily_rate: Decimal = DAILY_INTEREST, intent: bool = False) -> DataFrame:
    """Storage from interest on the running balance.

    Reference: running balance x daily rate per transaction row, negative
    gives 0, months pooled.  Intent: every day earns interest on the balance of
    the day before, with what it earned so far, and a calendar month's storage
    is that of the interest earned in it; a month that cost interest gives 0.

    The intent needs no row per day.  A change grows by (1 + r) each day, so a
    balance at a day is the sum of changes times (1 + r)^(days since).  Counted
    back to one fixed day, that is a plain running sum of (customer, month)
    sums, brought forward by one factor a month.  The interest of a month is the
    rise of the balance less the month's own changes; months without any are
    filled in between a customer's first and last.
    """
    if intent:
        log = math.log1p(float(daily_rate))
        grown = lambda day: F.exp(F.datediff(day, F.lit(RATE_EPOCH)) * log)
        tx = t.customer_transactions
        months = (tx.groupBy("customer_id", F.trunc("txn_date", "month").alias("month"))
                  .agg(F.sum(_signed()).alias("net"),
                       F.sum(_signed().cast("double") / grown(F.col("txn_date"))).alias("worth")))
        per = Window.partitionBy("customer_id").orderBy("month")
        so_far = per.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        spine = fill_months(months.withColumn("worth", F.sum("worth").over(so_far)), "customer_id", "month",
                            ["worth"], ["net"])
        balance = spine.withColumn("balance", F.col("worth") * grown(F.last_day("month")))
        earned = (F.col("balance") - F.coalesce(F.lag("balance").over(per), F.lit(0.0))
                  - F.col("net").cast("double"))
        gb = F.greatest(F.col("earned"), F.lit(0.0)) * float(GB_PER_UNIT)
        return (balance.withColumn("earned", earned).groupBy(*_calendar_month("month"))
                .agg(F.round(F.sum(gb), 2).cast(MONEY).alias("total_data_allocated_gb"))
                .orderBy("year_no", "month_no"))
    d = _daily_running(t)
    intr = F.col("running_bal") * F.lit(daily_rate)
    gb = F.when(intr < 0, F.lit(Decimal("0"))).otherwise(intr * F.lit(GB_PER_UNIT))
    return _sum_gb(d, F.col("n_rows") * gb)
