"""Next-row lookups in a per-key order, at day grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def next_date_in_order(df: DataFrame, key: str, ts_col: str, tie_col: str,
                       out: str, open_value: str = "9999-12-31") -> DataFrame:
    """Add ``out`` = date of the next row per ``key`` in (ts_col, tie_col) order.

    Same result as ``LEAD(ts_col) OVER (PARTITION BY key ORDER BY ts_col,
    tie_col)`` cast to a date, with ``open_value`` for the last row.  Rows of
    one day are consecutive in that order, so the next row lies in the same
    day for every row but the day's last one, whose next row opens the next
    non-empty day.  The window therefore runs over (key, day) rows only, whose
    number per key is bounded by the calendar span, not by the key's row
    count; the day table is joined back on (key, day).  Every row finds its
    day, so the join is written as a left join: a query that never reads
    ``out`` lets Catalyst drop the join and the window altogether.
    """
    day = F.to_date(ts_col)
    rows = df.withColumn("_day", day)
    last = F.max(F.struct(F.col(ts_col), F.col(tie_col)))
    days = rows.groupBy(key, "_day").agg(last.alias("_last"))
    w = Window.partitionBy(key).orderBy("_day")
    days = days.withColumn("_next_day", F.lead("_day").over(w))
    is_last = F.struct(F.col(ts_col), F.col(tie_col)) == F.col("_last")
    nxt = F.when(is_last, F.coalesce(F.col("_next_day"), F.to_date(F.lit(open_value)))) \
        .otherwise(F.col("_day"))
    return (rows.join(days, [key, "_day"], "left")
            .withColumn(out, nxt)
            .drop("_day", "_last", "_next_day"))
