"""Running totals with RANGE-frame semantics at day grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_total_by_day(df: DataFrame, key: str, day_col: str, amount: Column,
                         out: str = "running_total") -> DataFrame:
    """Per (key, day): row count ``n_rows``, ``day_total`` and running ``out``.

    ``SUM(x) OVER (PARTITION BY key ORDER BY day)`` uses the default RANGE
    frame, so all rows of one day share the running value: the total up to
    and including that day.  That value depends on the (key, day) totals
    only, so rows are summed per (key, day) first (map-side partial
    aggregation) and the window runs over one row per key and day, a count
    bounded by the calendar however hot the key.
    """
    days = df.groupBy(key, day_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.sum(amount).alias("day_total"))
    w = (Window.partitionBy(key).orderBy(day_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.withColumn(out, F.sum("day_total").over(w))
