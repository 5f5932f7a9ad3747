"""Calendar helpers. Every "now" is an explicit argument so that runs repeat."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = Column | datetime | date | str | None


def as_of_column(as_of: AsOf) -> Column:
    """The evaluation instant; the current timestamp when none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end`` (midnights crossed, not 24-hour spans)."""
    return F.datediff(end, start)


def month_of(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def fiscal_year_end(year: Column, as_of: AsOf) -> Column:
    """31 December of ``year``, or the evaluation date while the year is running."""
    return F.least(F.make_date(year, F.lit(12), F.lit(31)), as_of_column(as_of).cast("date"))


def within_lookback(timestamps: list[Column], days: int, as_of: AsOf) -> Column:
    """True when any of the timestamps falls in the last ``days`` days."""
    start = as_of_column(as_of) - F.make_dt_interval(days=F.lit(days))
    return reduce(or_, [ts >= start for ts in timestamps])
