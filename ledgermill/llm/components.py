"""Connected components by alternating large and small stars.

Every step is a grouped minimum and a join, so a node with very many links is aggregated
before it is shuffled and its join can be split. Steps are cut by written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.session import staged

MAX_STEPS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b) that is not the smallest
    of its component; ``component`` is the smallest node. Self links are ignored."""
    now = staged(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    for _ in range(MAX_STEPS):
        if _is_done(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(
            F.explode(
                F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
            ).alias("e")
        )
        now = staged(small.select("e.*").filter("a <> b").distinct(), "links")
    raise RuntimeError(f"no stable components after {MAX_STEPS} steps")


def _is_done(links: DataFrame) -> bool:
    """Whether every node links to one smaller node and that one to none."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("top"))
    ends = ends.unionAll(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("top")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("top").alias("top"))
    return nodes.agg(F.count_if(F.expr("up > 1 or (up = 1 and top = 1)"))).first()[0] == 0
