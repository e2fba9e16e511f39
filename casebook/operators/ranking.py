"""Ranking, group extremes and top-k without per-key raw-row windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def join_back(df: DataFrame, side: DataFrame, on: Sequence[str],
              how: str = "left") -> DataFrame:
    """Join ``side`` (unique on ``on``) to ``df``, treating NULL keys as equal."""
    on = list(on)
    renamed = side.select(*[F.col(c).alias(f"_r_{c}") for c in on],
                          *[c for c in side.columns if c not in on])
    cond = [df[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on]
    return df.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])


def rank_by(df: DataFrame, keys: Sequence[str], order_col: str, out: str,
            dense: bool = False) -> DataFrame:
    """Add ``RANK()`` (or ``DENSE_RANK()``) over ``keys`` ordered by ``order_col``.

    RANK is 1 + the number of rows of the group with a smaller value, and
    DENSE_RANK is 1 + the number of smaller distinct values.  Both need only
    the per-(keys, value) row counts, so the raw rows are first counted at
    that grain (map-side partial aggregation), the window runs over distinct
    values only (for a date that is bounded by the calendar, however hot
    the key), and the rank is joined back on (keys, value), which is unique
    on the counted side.  NULL values rank first, as ascending order does.
    """
    keys = list(keys)
    counts = df.groupBy(*keys, order_col).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc_nulls_first())
    if dense:
        r = F.row_number().over(w)
    else:
        r = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)) + 1
    ranked = counts.select(*keys, order_col, r.cast("int").alias(out))
    return join_back(df, ranked, [*keys, order_col])


def first_ranked(df: DataFrame, keys: Sequence[str], order: Column,
                 dense: bool = False) -> DataFrame:
    """Rows at rank 1 of their group by ``order``; ties kept.

    ``RANK() = 1`` (``DENSE_RANK() = 1`` if ``dense``) reads its input once and
    shuffles it once.  Spark plans a ``WindowGroupLimit`` below the shuffle, so
    a task sends only the rows that are first among its own rows of a group.
    """
    rank = (F.dense_rank() if dense else F.rank()).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def keep_extreme(df: DataFrame, keys: Sequence[str], value_col: str,
                 how: str = "min") -> DataFrame:
    """Rows whose ``value_col`` equals the group's min (or max); ties kept.

    Equivalent to ``RANK() ... = 1`` and to joining a fact to its own
    grouped MIN/MAX.  The extreme is a partial aggregate, so a hot key
    costs one pre-aggregated row per map task; the join back is on
    (keys, value), unique on the extreme side.
    """
    agg = F.min(value_col) if how == "min" else F.max(value_col)
    ext = df.groupBy(*keys).agg(agg.alias(value_col))
    return df.join(ext, [*keys, value_col])


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """``TOP k ... ORDER BY``: planned as ``TakeOrderedAndProject``.

    Each task keeps only its k best rows, so only k rows per task cross the
    network.  Callers pass a full tie-break so the result is deterministic.
    """
    return df.orderBy(*order).limit(k)


def rows_at_max(df: DataFrame, value_col: str) -> DataFrame:
    """Rows where ``value_col`` equals its overall maximum (ties kept).

    The maximum is a one-row aggregate, so broadcasting it is bounded; the
    join is an equi-join on the value, not a cross join.
    """
    mx = df.agg(F.max(value_col).alias("_max"))
    return (df.join(F.broadcast(mx), F.col(value_col) == F.col("_max"))
            .drop("_max"))
