"""Date helpers that keep results repeatable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: str | None = None) -> Column:
    """The reference date of a run: a fixed ``yyyy-MM-dd`` when given,
    else ``current_date()`` (which Spark fixes once per query)."""
    return F.lit(as_of).cast("date") if as_of else F.current_date()


def days_since(date_col, as_of: str | None = None) -> Column:
    """``datediff(as_of, date)`` in days."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.datediff(as_of_date(as_of), d)
