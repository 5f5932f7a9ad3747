"""Clustering of files by several times at once, so that Parquet statistics can skip them.

A look-back asks for rows whose creation, shipment or return is recent. Files sorted by one of
the times serve that one only. Along a Z-curve, which interleaves the bits of the day numbers,
every run of rows spans few days of each time, so minimum and maximum of each row group
exclude most of them for all three. The curve is the same for every table and batch: no
statistics are gathered first, and files written on different days line up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_BITS = 15  # days from 1970-01-01 to 2059-09-18; others share the first or the last
MOST_TIMES = 4  # 60 bits of a long


def day_number(time: Column) -> Column:
    """Days since 1970 in ``DAY_BITS`` bits; 0 without a time."""
    day = F.unix_date(time.cast("date"))
    bounded = F.least(F.greatest(day, F.lit(0)), F.lit((1 << DAY_BITS) - 1))
    return F.coalesce(bounded, F.lit(0)).cast("long")


def z_value(times: list[str] | tuple[str, ...]) -> Column:
    """Position on the Z-curve through the days of up to four times."""
    if not 1 <= len(times) <= MOST_TIMES:
        raise ValueError(f"a Z-curve takes 1 to {MOST_TIMES} times, not {len(times)}")
    bits = [
        F.shiftleft(F.shiftright(day_number(F.col(name)), bit).bitwiseAND(F.lit(1)),
                    bit * len(times) + place)
        for place, name in enumerate(times)
        for bit in range(DAY_BITS)
    ]
    return reduce(Column.bitwiseOR, bits)


def clustered(df: DataFrame, times: list[str] | tuple[str, ...]) -> DataFrame:
    """The rows in ranges of the Z-curve, sorted within each; one range shuffle.

    Rows of the same days, such as the many without any time, are dealt over several ranges by
    a hash of all their columns. The ranges come from a sample that Spark draws of the input,
    so an expensive input should be staged first.
    """
    place, spread = z_value(times), F.xxhash64(*[F.col(c) for c in df.columns])
    named = df.withColumns({"z_place": place, "z_spread": spread})
    ranged = named.repartitionByRange("z_place", "z_spread")
    return ranged.sortWithinPartitions("z_place").drop("z_place", "z_spread")
