"""Ordered string aggregation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ordered_string_agg(value: str, order_col: str, sep: str = ", ") -> Column:
    """``STRING_AGG(value, sep) WITHIN GROUP (ORDER BY order_col)``.

    NULL values are skipped; a group of only NULLs gives NULL.  Only the
    non-NULL values are buffered, and partial buffers merge map-side.
    """
    s = sep.replace("'", "''")
    return F.expr(f"listagg(`{value}`, '{s}') WITHIN GROUP (ORDER BY `{order_col}`)")
