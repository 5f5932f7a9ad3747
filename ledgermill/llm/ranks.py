"""Places in a seeded order without one task per group.

A hash of each row cuts every group into buckets. The counts (or sums) of the buckets are
small and give each bucket its start; only the rows of one bucket are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3  # hexadecimal digits of the hash: 4,096 buckets per group


def with_running_sum(
    rows: DataFrame, group: str, order: str, ties: list[str], amount: Column, name: str
) -> DataFrame:
    """``rows`` plus ``name``: the sum of ``amount`` over the rows of the group that come
    before, and ``<name>_total``: the sum over the group.

    ``order`` is a column of hexadecimal hashes; ``ties`` order equal hashes.
    """
    cut = rows.withColumn("__bucket", F.substring(order, 1, BUCKET_DIGITS)).withColumn(
        "__amount", amount
    )
    sums = cut.groupBy(group, "__bucket").agg(F.sum("__amount").alias("__sum"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        group,
        "__bucket",
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"),
        F.sum("__sum").over(whole).alias(f"{name}_total"),
    )
    inside = (
        Window.partitionBy(group, "__bucket")
        .orderBy(order, *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        cut.join(starts, [group, "__bucket"])
        .withColumn(name, F.col("__start") + F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
        .drop("__bucket", "__amount", "__start")
    )
