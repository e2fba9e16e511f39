"""Arithmetic with explicit typing (integer division, guarded ratios)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_div(a, b) -> Column:
    """Integer ``a / b`` truncating toward zero, NULL when ``b`` is 0 (R1, R9)."""
    return F.call_function("div", _c(a).cast("bigint"),
                           F.nullif(_c(b).cast("bigint"), F.lit(0)))


def int_avg(x) -> Column:
    """``AVG`` over an integer column: ``sum div count``, truncating (R1)."""
    x = _c(x)
    return int_div(F.sum(x), F.count(x))


def ratio(a, b) -> Column:
    """``CAST(a AS FLOAT) / NULLIF(b, 0)`` as a double."""
    return _c(a).cast("double") / F.nullif(_c(b), F.lit(0)).cast("double")


def pct_change(after, before, digits: int) -> Column:
    """``ROUND(100.0 * (after - before) / NULLIF(before, 0), digits)`` as double."""
    a, b = _c(after), _c(before)
    return F.round(F.lit(100.0) * (a - b).cast("double") / F.nullif(b, F.lit(0)).cast("double"),
                   digits)


def signed_amount(kind, amount, credits: Iterable[str] = ("deposit",),
                  debits: Iterable[str] = ("withdrawal", "purchase"),
                  other=0) -> Column:
    """Amount with sign by transaction kind; other kinds, NULL too, give ``other``.

    Kinds are compared without regard to case (R3).
    """
    k, a, other = F.lower(_c(kind)), _c(amount), _c(other) if isinstance(other, str) else other
    return (F.when(k.isin(*credits), a)
            .when(k.isin(*debits), -a)
            .otherwise(other if isinstance(other, Column) else F.lit(other)))


def ci_eq(col, value: str) -> Column:
    """Case-insensitive equality, as under a case-insensitive collation (R3)."""
    return F.lower(_c(col)) == value.lower()
