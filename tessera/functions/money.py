"""Exact money arithmetic.

Money arrives as doubles with two decimals.  Summing doubles is
order-dependent in the last bits and ``round(double, 2)`` rounds the binary
value, so results would change with partitioning.  These helpers move money
to integer cents (exact), do the arithmetic on longs and convert back to a
double once, at the end.  Every rounding takes halves away from zero, which is what
``F.round`` does on the decimal text of a value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_div(num, den) -> Column:
    """Integer division of longs, truncating toward zero (SQL ``div``)."""
    return F.call_function("div", _c(num).cast("long"), _c(den).cast("long"))


def cents(x) -> Column:
    """Money double -> exact long cents (via decimal(18,2), half-up)."""
    return (_c(x).cast("decimal(18,2)") * 100).cast("long")


def money_from_cents(c) -> Column:
    """Long cents -> double money."""
    return _c(c) / F.lit(100.0)


def sum_money(x) -> Column:
    """Exact sum of a money column, returned as double (null over no rows)."""
    return F.sum(_c(x).cast("decimal(18,2)")).cast("double")


def half_up_div(num, den) -> Column:
    """round(num / den), halves away from zero, as a long; den > 0."""
    n = _c(num).cast("long")
    d = _c(den).cast("long")
    return int_div(n * 2 + F.signum(n).cast("long") * d, d * 2)


def round_ratio(num, den, digits: int = 2, scale: int = 1) -> Column:
    """``round(scale * num / den, digits)`` computed exactly on integers.

    ``num`` and ``den`` are integer columns with ``den`` > 0.
    """
    p = 10 ** digits
    return half_up_div(_c(num).cast("long") * (scale * p), den) / F.lit(float(p))


def avg_money(x) -> Column:
    """``round(avg(x), 2)`` of money, exact on cents.

    Null when the group has no non-null value, like ``avg``.
    """
    n = F.count(_c(x))
    return F.when(n > 0, half_up_div(F.sum(cents(x)), n) / F.lit(100.0))
