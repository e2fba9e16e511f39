"""Rows for calendar months without data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def fill_months(df: DataFrame, key: str, month: str, carried: Sequence[str] = (),
                empty: Sequence[str] = ()) -> DataFrame:
    """One row per month of each key, from its first to its last one.

    ``df`` has one row per (key, first day of a month).  A month without a row
    gets one with the ``carried`` values of the last month before it and 0 in
    the ``empty`` ones.  Each row is repeated up to the next row's month, so the
    window sees the months that have data only, a count bounded by the calendar.
    """
    following = F.lead(month).over(Window.partitionBy(key).orderBy(month))
    until = F.coalesce(F.add_months("_next", -1), F.col(month))
    filled = (df.withColumn("_next", following)
              .withColumn("_month", F.explode(F.sequence(F.col(month), until, F.expr("interval 1 month")))))
    own = F.col("_month") == F.col(month)
    return filled.select(key, F.col("_month").alias(month), *carried,
                         *[F.when(own, F.col(c)).otherwise(0).alias(c) for c in empty])
