"""Source freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.calendar import AsOf, as_of_column

# Ages in hours, sized to a daily load.
WARN_HOURS = 30
ERROR_HOURS = 54
SECONDS_PER_HOUR = 3600


def freshness(
    df: DataFrame,
    column: str = "created_at",
    warn_hours: int = WARN_HOURS,
    error_hours: int = ERROR_HOURS,
    as_of: AsOf = None,
) -> DataFrame:
    """One row: newest load time, its age in hours and pass, warn or error.

    A table without rows has never been loaded and is an error.
    """
    age = F.unix_timestamp(as_of_column(as_of)) - F.unix_timestamp("max_loaded_at")
    hours = age / F.lit(SECONDS_PER_HOUR)
    return df.agg(F.max(column).alias("max_loaded_at")).select(
        "max_loaded_at",
        hours.alias("age_hours"),
        F.when(hours <= warn_hours, "pass")
        .when(hours <= error_hours, "warn")
        .otherwise("error")
        .alias("status"),
    )
