"""Running sums without one ordered pass over a whole group.

Rows are cut into blocks along their order. The sums of the blocks are small and give each
block its start; only the rows of one block are ordered together. A total over all days of a
ledger, which has no group to part it, runs in as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DAYS = 64


def day_block(day: Column, days: int = BLOCK_DAYS) -> Column:
    """The number of a day's block."""
    return F.floor(F.unix_date(day.cast("date")) / days)


def running_sums(
    rows: DataFrame, group: list[str], order: str, amounts: list[str], block: Column | None = None
) -> DataFrame:
    """``rows`` plus ``running_<amount>`` for each amount and ``next_<order>``.

    ``rows`` holds one row per group and value of ``order``, which is not NULL; ``block``
    never falls as ``order`` rises (blocks of days by default). A running sum includes its own
    row; NULL amounts add nothing, and a sum is NULL until the first amount. ``next_<order>``
    is the following value in the group, NULL at its end.
    """
    cut = rows.withColumn("__block", day_block(F.col(order)) if block is None else block)
    sums = [F.sum(a).alias(f"__{i}") for i, a in enumerate(amounts)]
    blocks = cut.groupBy(*group, "__block").agg(*sums, F.min(order).alias("__first"))
    along = Window.partitionBy(*group).orderBy("__block")  # one row per block
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        *[F.col(g).alias(f"__group{i}") for i, g in enumerate(group)],
        F.col("__block").alias("__of"),
        F.lead("__first").over(along).alias("__following"),
        *[F.sum(f"__{i}").over(before).alias(f"__start{i}") for i in range(len(amounts))],
    )
    same = F.col("__block") == F.col("__of")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__group{i}"))
    inside = Window.partitionBy(*group, "__block").orderBy(order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns(
        {f"__local{i}": F.sum(a).over(so_far) for i, a in enumerate(amounts)}
        | {"__next": F.lead(order).over(inside)}
    )

    def total(i: int) -> Column:
        start, here = F.col(f"__start{i}"), F.col(f"__local{i}")
        return F.coalesce(start + here, start, here)

    return local.join(starts, same).select(
        *rows.columns,
        *[total(i).alias(f"running_{a}") for i, a in enumerate(amounts)],
        F.coalesce("__next", "__following").alias(f"next_{order}"),
    )
