"""Calendar spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.calendar import AsOf, as_of_column

SPINE_START = "2019-01-01"
YEARS_AHEAD = 3


def days_in(start: Column, end: Column) -> Column:
    """Array of the days from ``start`` to ``end``, the end excluded."""
    last = F.date_sub(end, 1)
    day = F.make_dt_interval(days=F.lit(1))
    return F.when(last >= start, F.sequence(start, last, day))


def time_spine(
    spark: SparkSession, start: str = SPINE_START, end: Column | None = None, as_of: AsOf = None
) -> DataFrame:
    """One row per day from ``start`` to the start of the as-of year plus three, exclusive."""
    if end is None:
        this_year = F.date_trunc("year", as_of_column(as_of)).cast("date")
        end = F.add_months(this_year, 12 * YEARS_AHEAD)
    first = F.lit(start).cast("date")
    return spark.range(1).select(F.explode(days_in(first, end)).alias("date_day"))
