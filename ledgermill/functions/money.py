"""Exact, order-independent money arithmetic that stays in generated code.

A sum of doubles depends on the order of its rows, which on a cluster changes from run
to run. Amounts are therefore cut into whole units and millionths of a unit, and both are
added as plain longs: eight times faster than a decimal sum, with room for 9.2e18 currency
units per group. An amount or a sum outside that range is an error in every session,
whatever its ANSI setting. What is below half a millionth of a unit is rounded away per amount.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 6
LIMIT = 9.2e18


def split_amount(amount: Column) -> tuple[Column, Column]:
    """Whole units and millionths of an amount, as longs."""
    whole = F.floor(amount)
    beyond = F.raise_error(F.lit(f"an amount is not a number within {LIMIT:g}"))
    units = F.when(F.abs(amount) >= F.lit(LIMIT), beyond.cast("long")).otherwise(whole)
    return units, F.rint((amount - whole) * F.lit(float(10**PLACES))).cast("long")


def join_amount(high: Column, low: Column) -> Column:
    """The two parts put back together, as a decimal with six places."""
    millionths = low.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-PLACES))
    return high.cast("decimal(20,0)") + millionths


def checked_sum(part: Column) -> Column:
    """Sum of longs. One beyond their range is an error with ANSI mode off, too."""
    total = F.try_sum(part)
    beyond = F.raise_error(F.lit(f"a sum is not within {LIMIT:g}")).cast("long")
    return F.when(total.isNull() & (F.count(part) > 0), beyond).otherwise(total)


def checked_product(amount: Column, weight: Column) -> Column:
    """``amount * weight`` of longs, an error beyond their range."""
    found = F.try_multiply(amount, weight.cast("long"))
    beyond = F.raise_error(F.lit(f"an amount times its weight is not within {LIMIT:g}"))
    missing = amount.isNotNull() & weight.isNotNull() & found.isNull()
    return F.when(missing, beyond.cast("long")).otherwise(found)


def exact_sum(amount: Column, weight: Column | None = None) -> Column:
    """Sum of a double column, optionally of ``amount * weight``, as a decimal."""
    high, low = split_amount(amount)
    if weight is not None:
        high, low = checked_product(high, weight), checked_product(low, weight)
    return join_amount(checked_sum(high), checked_sum(low))


def to_cents(amount: Column) -> Column:
    """Rounded half up to two places, as a double."""
    return F.round(amount, 2).cast("double")


def money_sum(amount: Column, weight: Column | None = None) -> Column:
    return to_cents(exact_sum(amount, weight))


def round_to(value: Column, places: int) -> Column:
    """A double rounded half away from zero after scaling.

    Spark rounds the shortest decimal form of a double, other engines round the scaled
    double. They part at ties such as 1.005, and reports are compared with the latter.
    """
    scale = F.lit(float(10**places))
    return F.round(value * scale) / scale


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; NULL where the denominator is 0."""
    return numerator / F.nullif(denominator, F.lit(0))
