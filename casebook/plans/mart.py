"""Weekly retail mart: cleaning, shares and before/after comparisons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from casebook.functions import ci_eq, int_div, parse_dmy2, pct_change, ratio, \
    us_week, us_week_of_dmy2, weekday_name
from casebook.operators import merge_spellings, not_in_values, period_sum, unpivot_dims

# Reference literals.
CHANGE_DATE = dt.date(2020, 6, 15)
CHANGE_YEAR = 2020
WEEKS_4 = ((21, 24), (25, 28))
WEEKS_12 = ((13, 24), (25, 37))
WEEKS_12_INTENT = ((13, 24), (25, 36))
N_WEEKS = 53
AREA_DIMS = ("region", "platform", "age_band", "demographic", "customer_type")
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}
DEMOGRAPHICS = {"C": "Couples", "F": "Families"}
SHARE_TYPE = "decimal(5,2)"
PCT_TYPE = "decimal(10,2)"


def clean(t) -> DataFrame:
    """``clean_weekly_sales`` from the raw weekly table (one narrow projection).

    week_date text ``d/M/yy`` -> DATE (NULL when invalid); Sunday-start week
    number; month; year; age band and demographic from the segment code;
    segment ``'null'`` -> ``'unknown'``; ``avg_transactions`` = integer
    ``sales / transactions`` (NULL for 0 or NULL transactions).
    """
    d = parse_dmy2("week_date")
    seg = F.col("segment")
    last, first = F.right(seg, F.lit(1)), F.left(seg, F.lit(1))
    age = F.when(last == "1", AGE_BANDS["1"]).when(last == "2", AGE_BANDS["2"]) \
        .when(last.isin("3", "4"), AGE_BANDS["3"]).otherwise("Unknown")
    demo = F.when(ci_eq(first, "C"), DEMOGRAPHICS["C"]).when(ci_eq(first, "F"), DEMOGRAPHICS["F"]) \
        .otherwise("unknown")
    tx = F.col("transactions")
    return (t.data_mart.withColumn("_d", d)
            .select(F.col("_d").alias("week_date"),
                    us_week_of_dmy2("week_date").alias("week_number"),
                    F.month("_d").cast("int").alias("month_number"),
                    F.year("_d").cast("int").alias("calendar_year"),
                    "region", "platform",
                    age.alias("age_band"), demo.alias("demographic"),
                    F.when(ci_eq(seg, "null"), "unknown").otherwise(seg).alias("segment"),
                    "customer_type", "transactions", "sales",
                    F.when(tx.isNotNull() & (tx != 0), int_div("sales", "transactions"))
                    .alias("avg_transactions")))


def _cws(t, only: Column | None = None) -> DataFrame:
    """``clean_weekly_sales``, stored or as cleaned on the way.

    ``only`` narrows a stored table, where it prunes folders and row groups.  On
    the way it would be moved below the weekly aggregation and parse a date for
    every raw row, so there the callers' own conditions decide after it.
    """
    cws = getattr(t, "clean_weekly_sales", None)
    if cws is None:
        return clean(t)
    return cws if only is None else cws.where(only)


def _sales() -> Column:
    return F.col("sales").cast("bigint")


def _share(part: Column, total: Column, digits: int, typ: str) -> Column:
    return F.round(F.lit(100.0) * ratio(part, total), digits).cast(typ)


def weekday(t) -> DataFrame:
    """Distinct weekday names of week_date."""
    return _cws(t).select(weekday_name("week_date").alias("day_name")).distinct()


def missing_weeks(t, year: int | None = None, n_weeks: int = N_WEEKS) -> DataFrame:
    """Week numbers 1..n_weeks absent from the data (``NOT IN`` semantics).

    ``year`` narrows the data to one calendar year (the reference uses the
    whole table).  The weeks that occur are at most 54, so they are gathered
    as one set.  As with ``NOT IN``, a NULL week in the data (from an
    unparseable date) makes the result empty.
    """
    in_year = F.lit(True) if year is None else F.col("calendar_year") == year
    week = F.when(in_year, F.col("week_number"))
    unknown = F.max(F.when(in_year & F.col("week_number").isNull(), True))
    seen = (_cws(t, in_year).agg(F.collect_set(week).alias("weeks"), unknown.alias("unknown"))
            .select(F.explode(F.when(F.col("unknown"), F.array_append("weeks", F.lit(None).cast("int")))
                              .otherwise(F.col("weeks"))).alias("week_number")))
    seq = seen.sparkSession.range(1, n_weeks + 1).withColumnRenamed("id", "missing_week_num")
    return not_in_values(seq, "missing_week_num", seen, "week_number")


def txn_by_year(t) -> DataFrame:
    return (_cws(t).groupBy("calendar_year")
            .agg(F.sum("transactions").cast("bigint").alias("total_transactions"))
            .orderBy("calendar_year"))


def sales_region_month(t) -> DataFrame:
    """Sales per month number (years pooled) and region."""
    g = (_cws(t).groupBy("month_number", "region")
         .agg(F.sum(_sales()).alias("total_sales_region_month")))
    return (merge_spellings(g, ["region"], ["month_number"], ["total_sales_region_month"])
            .orderBy("month_number", "region"))


def txn_by_platform(t) -> DataFrame:
    g = (_cws(t).groupBy("platform")
         .agg(F.sum("transactions").cast("bigint").alias("total_count_of_transaction")))
    return merge_spellings(g, ["platform"], sums=["total_count_of_transaction"])


def platform_share(t) -> DataFrame:
    """Percent of each month's sales by platform (Retail, Shopify).

    Platforms are grouped and matched case-insensitively, as under the
    reference's collation.
    """
    m = (_cws(t).groupBy("calendar_year", "month_number",
                         F.lower("platform").alias("platform"))
         .agg(F.sum(_sales()).alias("monthly_sales")))
    tot = F.sum("monthly_sales")
    return (m.groupBy("calendar_year", "month_number")
            .agg(_share(F.max(F.when(ci_eq("platform", "Retail"), F.col("monthly_sales"))),
                        tot, 2, SHARE_TYPE).alias("retail"),
                 _share(F.max(F.when(ci_eq("platform", "Shopify"), F.col("monthly_sales"))),
                        tot, 2, SHARE_TYPE).alias("shopify"))
            .orderBy("calendar_year", "month_number"))


def demographic_share(t) -> DataFrame:
    """Percent of each year's sales by demographic (case-insensitive labels)."""
    y = (_cws(t).groupBy("calendar_year", F.lower("demographic").alias("demographic"))
         .agg(F.sum(_sales()).alias("yearly_sales")))
    tot = F.sum("yearly_sales")

    def part(label):
        return _share(F.max(F.when(ci_eq("demographic", label), F.col("yearly_sales"))),
                      tot, 2, PCT_TYPE)
    return (y.groupBy("calendar_year")
            .agg(part("families").alias("sales_families"),
                 part("couples").alias("sales_couples"),
                 part("unknown").alias("sales_unknown")))


def retail_contribution(t, platform: str = "retail") -> DataFrame:
    """Retail sales by (age_band, demographic) and their percent of the total.

    The grand total is a one-row scalar subquery over the grouped rows, not
    a window over one partition.
    """
    g = (_cws(t).where(ci_eq("platform", platform))
         .groupBy("age_band", "demographic")
         .agg(F.sum(_sales()).alias("total_sales")))
    total = g.agg(F.sum("total_sales")).scalar()
    return g.select("age_band", "demographic", "total_sales",
                    _share(F.col("total_sales"), total, 1, PCT_TYPE)
                    .alias("percent_contributions")).orderBy(F.desc("total_sales"),
                                                             "age_band", "demographic")


def avg_transaction(t, by_platform: bool = False) -> DataFrame:
    """Mean of the row means (integer) against the ratio of sums, per year.

    ``by_platform=True`` adds the platform split the question asks for.
    """
    text = ["platform"] if by_platform else []
    sums = {"_n": F.count("avg_transactions"), "_means": F.sum("avg_transactions"),
            "_sales": F.sum(_sales()), "_txn": F.sum("transactions")}
    g = _cws(t).groupBy("calendar_year", *text).agg(*[x.alias(n) for n, x in sums.items()])
    if text:
        g = merge_spellings(g, text, ["calendar_year"], list(sums))
    return (g.select("calendar_year", *text,
                     int_div("_means", "_n").cast(PCT_TYPE).alias("incorrect_avg_method"),
                     F.round(ratio("_sales", "_txn"), 2).cast(PCT_TYPE).alias("avg_txn"))
            .orderBy("calendar_year", *text))


def change_week(t, change_date: dt.date = CHANGE_DATE, year: int = CHANGE_YEAR) -> DataFrame:
    """Week number of the change date; a year has at most 54, gathered as one set."""
    on_date = (F.col("week_date") == F.lit(change_date)) & (F.col("calendar_year") == year)
    weeks = F.collect_set(F.when(on_date, F.col("week_number")))
    return _cws(t, on_date).agg(weeks.alias("weeks")).select(F.explode("weeks").alias("week_number"))


def _compare(df: DataFrame, before: Column, after: Column, diff_name: str,
             pct_name: str, digits: int) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c not in ("sales_before", "sales_after")],
        "sales_before", "sales_after",
        (F.col("sales_after") - F.col("sales_before")).alias(diff_name),
        pct_change("sales_after", "sales_before", digits).cast(PCT_TYPE).alias(pct_name))


def before_after(t, weeks=WEEKS_4, year: int | None = None,
                 diff_name: str = "sales_diff", pct_name: str = "percent_diff") -> DataFrame:
    """Sales in the weeks before against after the change; one row.

    ``year=None`` pools all years, as the reference's 4-week query does.
    """
    (b_lo, b_hi), (a_lo, a_hi) = weeks
    wk = F.col("week_number")
    of_year = F.lit(True) if year is None else F.col("calendar_year") == year
    df = _cws(t, wk.between(min(b_lo, a_lo), max(b_hi, a_hi)) & of_year)
    s = df.agg(period_sum(_sales(), wk, b_lo, b_hi, of_year).alias("sales_before"),
               period_sum(_sales(), wk, a_lo, a_hi, of_year).alias("sales_after"))
    return _compare(s, F.col("sales_before"), F.col("sales_after"), diff_name, pct_name, 1)


def before_after_changes(t, n_weeks: int = 4, since: dt.date | None = None) -> DataFrame:
    """Sales in the weeks before and after each change of ``t.change_dates``.

    The weeks are the ``n_weeks`` before that of the change and the ``n_weeks``
    from it on, within its year.  Changes dated before ``since`` take no part.
    All changes are compared in one pass over the weekly sums, which meet them
    by year; a stored ``clean_weekly_sales`` is laid out by year, so the years
    without a change are not read (dynamic partition pruning).  A change without
    sales has NULL sums.
    """
    changes = t.change_dates if since is None else t.change_dates.where(F.col("change_date") >= F.lit(since))
    at = changes.select("change_name", "change_date", F.year("change_date").alias("_year"),
                        us_week("change_date").alias("_week"))
    stored = getattr(t, "clean_weekly_sales", None)
    weeks = ((clean(t) if stored is None else stored).select("calendar_year", "week_number", "sales"))
    # A plain equality would test the parsed year for NULL below the weekly
    # aggregation, for every raw row.
    year = F.col("calendar_year")
    same = year.eqNullSafe(F.col("_year")) if stored is None else year == F.col("_year")
    off = F.col("week_number") - F.col("_week")
    sums = (at.join(weeks, same, "left").groupBy("change_name", "change_date")
            .agg(period_sum(_sales(), off, -n_weeks, -1).alias("sales_before"),
                 period_sum(_sales(), off, 0, n_weeks - 1).alias("sales_after")))
    return _compare(sums, None, None, "sales_diff", "percent_diff", 1).orderBy("change_date", "change_name")


def before_after_years(t, weeks=WEEKS_4) -> DataFrame:
    """The before/after comparison per calendar year."""
    (b_lo, b_hi), (a_lo, a_hi) = weeks
    wk = F.col("week_number")
    s = (_cws(t).groupBy("calendar_year")
         .agg(period_sum(_sales(), wk, b_lo, b_hi).alias("sales_before"),
              period_sum(_sales(), wk, a_lo, a_hi).alias("sales_after")))
    return _compare(s, F.col("sales_before"), F.col("sales_after"),
                    "sales_diff_year", "percent_diff_12w", 1).orderBy("calendar_year")


def _area_sums(df: DataFrame, weeks, year: int) -> DataFrame:
    """Sums per value of each dimension, with the number of rows in the weeks as ``_in``."""
    (b_lo, b_hi), (a_lo, a_hi) = weeks
    long = unpivot_dims(df, AREA_DIMS, ["calendar_year", "week_number", "sales"])
    in_year = F.col("calendar_year") == year
    wk = F.col("week_number")
    g = (long.groupBy("metric", "value")
         .agg(period_sum(_sales(), wk, b_lo, b_hi, in_year).alias("sales_before"),
              period_sum(_sales(), wk, a_lo, a_hi, in_year).alias("sales_after"),
              F.count_if(in_year & wk.between(b_lo, a_hi)).alias("_in")))
    return (merge_spellings(g, ["value"], ["metric"], ["sales_before", "sales_after", "_in"])
            .withColumn("value", F.coalesce(F.col("value"), F.lit("unknown"))))


def impact_by_area(t, weeks=WEEKS_12, year: int = CHANGE_YEAR) -> DataFrame:
    """Before/after sales for every value of the five business dimensions.

    One scan feeds an unpivot (``Expand``) and a single aggregation, instead
    of one scan per dimension.  Values with no rows in the range keep NULL
    sums.
    """
    return _compare(_area_sums(_cws(t), weeks, year).drop("_in"), None, None,
                    "sales_diff", "percent_diff", 2).orderBy("percent_diff", "metric", "value")


def worst_area(t, weeks=WEEKS_12, year: int = CHANGE_YEAR) -> DataFrame:
    """Per dimension, the value with the lowest percent change.

    Values without rows in the year and weeks take no part.  Ties go to the
    smaller value; NULL percent changes sort first, as ascending order does.
    """
    (b_lo, _), (_, a_hi) = weeks
    df = _cws(t, (F.col("calendar_year") == year) & F.col("week_number").between(b_lo, a_hi))
    areas = _area_sums(df, weeks, year).where("_in > 0").drop("_in")
    c = _compare(areas, None, None, "sales_diff", "percent_diff", 2)
    w = Window.partitionBy("metric").orderBy(F.col("percent_diff").asc_nulls_first(),
                                             F.col("value").asc_nulls_first())
    return (c.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
            .orderBy("percent_diff", "metric"))
