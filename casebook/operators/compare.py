"""Period comparisons and dimension unpivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def period_sum(value, period: Column, lo: int, hi: int,
               cond: Column | None = None) -> Column:
    """``SUM(CASE WHEN cond AND period BETWEEN lo AND hi THEN value END)``."""
    c = period.between(lo, hi)
    if cond is not None:
        c = cond & c
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(c, v))


def merge_spellings(grouped: DataFrame, text: Sequence[str], others: Sequence[str] = (),
                    sums: Sequence[str] = ()) -> DataFrame:
    """Groups of ``grouped`` that differ in the case of ``text`` only, as one row.

    Text is compared without regard to case, and a group shows one of its own
    spellings (the first in code-point order); none is made up.  ``sums`` are the
    additive columns.  It runs on groups that are already aggregated by exact
    spelling, so the rows it moves are few.
    """
    keys = [F.lower(c).alias(f"_key_{c}") for c in text]
    return (grouped.groupBy(*others, *keys)
            .agg(*[F.min(c).alias(c) for c in text], *[F.sum(c).alias(c) for c in sums])
            .select(*others, *text, *sums))


def unpivot_dims(df: DataFrame, dims: Sequence[str], keep: Sequence[str],
                 metric: str = "metric", value: str = "value") -> DataFrame:
    """One row per (input row, dimension): ``metric`` names the dimension.

    Replaces a UNION ALL with one branch per dimension: Spark plans this as
    a single scan feeding an ``Expand``.  NULL values are kept.
    """
    cols = [F.col(d).cast("string").alias(d) for d in dims]
    return (df.select(*keep, *cols)
            .unpivot(list(keep), list(dims), metric, value))
