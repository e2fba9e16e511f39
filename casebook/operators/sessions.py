"""Gap-based sessionisation that splits hot users by time bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T


def sessionize(df: DataFrame, user_col: str, ts_col: str, out: str,
               gap_hours: int = 12) -> DataFrame:
    """Add ``out`` = 1-based session number per user.

    A row opens a new session when the gap to the user's previous row is
    more than ``gap_hours`` (a gap of exactly ``gap_hours`` continues).  This
    equals ``SUM(new) OVER (PARTITION BY user ORDER BY ts ROWS UNBOUNDED
    PRECEDING)`` with ``new = ts - LAG(ts) > gap``.

    Rows are cut into aligned buckets ``gap_hours`` wide.  Two rows of one
    bucket are less than the gap apart, so only the first row of a bucket
    can open a session, and it does so iff it lies more than the gap after
    the last row of the user's previous non-empty bucket.  The window thus
    runs over (user, bucket) aggregates — bounded by the time span, not by
    the user's row count — and the numbers are joined back on
    (user, bucket).  No per-user window over raw rows is needed.  Every row
    finds its bucket, so the join is a left join, which Catalyst removes
    from queries that never read the session number.
    """
    if 24 % gap_hours:
        raise ValueError("gap_hours must divide 24")
    ts = F.col(ts_col)
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        # Wall-clock times: buckets from the day number and the hour.
        per_day = 24 // gap_hours
        bucket = (F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) * per_day
                  + F.floor(F.hour(ts) / gap_hours)).cast("long")
    else:
        # Instants: buckets from epoch seconds, so a daylight-saving change
        # in the session time zone cannot stretch a bucket past the gap.
        bucket = F.floor(F.unix_seconds(ts) / (gap_hours * 3600)).cast("long")
    rows = df.withColumn("_bucket", bucket)
    buckets = rows.groupBy(user_col, "_bucket").agg(F.min(ts).alias("_first"),
                                                    F.max(ts).alias("_last"))
    w = Window.partitionBy(user_col).orderBy("_bucket")
    prev_last = F.lag("_last").over(w)
    gap = F.expr(f"INTERVAL {int(gap_hours)} HOURS")
    opens = F.when(prev_last.isNull() | (F.col("_first") > prev_last + gap), 1).otherwise(0)
    numbered = (buckets.withColumn("_open", opens)
                .withColumn(out, F.sum("_open").over(
                    w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long"))
                .select(user_col, "_bucket", out))
    return rows.join(numbered, [user_col, "_bucket"], "left").drop("_bucket")
