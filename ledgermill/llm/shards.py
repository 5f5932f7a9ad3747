"""Shards that each match the mixture of sources: proportional stratified interleaving.

Rows of a source are ranked in a seeded order; rank over size is a fraction between 0 and 1;
sorting all rows by it interleaves the sources in proportion, and equal cuts of that order are
the shards. Built of DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.ranks import with_running_sum
from ledgermill.llm.text import md5_text
from ledgermill.session import staged

SLICES = 4096  # equal stretches of the interleaved order that are sorted apart


def assign_shards(
    docs: DataFrame, n_shards: int, id_column: str = "doc_id", source_column: str = "source",
    seed: int = 0,
) -> DataFrame:
    """``docs`` plus shard (0 to ``n_shards`` - 1) and slot (its place in the shard, from 0).

    The law is ``rows``: shard sizes differ by one at most, and a shard holds of each source
    its share, give or take one row and the rounding of the cut. A null source is a source of
    its own; rows with equal ids and sources are ordered by their other columns; empty and
    null texts are rows like others. With fewer rows than shards the last shards stay empty.
    Columns of ``docs`` named shard or slot are replaced.
    """
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    source = F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit("null"))
    plain = [c for c in columns if dict(docs.dtypes)[c] not in ("variant",) and "map<" not in dict(docs.dtypes)[c]]
    keyed = docs.select(*[F.col(f"`{c}`") for c in columns]).select(
        "*",
        source.alias("__source"),
        md5_text(F.lit(seed), F.col(id_column), source).alias("__order"),
    )
    ranked = with_running_sum(
        keyed, "__source", "__order", [f"`{c}`" for c in plain], F.lit(1).cast("long"), "__rank"
    )
    # each source starts at its own point of the first step, so that many sources of one row
    # spread over all shards
    first = F.conv(F.substring(F.md5("__source"), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    fraction = (F.col("__rank") + first) / F.col("__rank_total")
    spread = staged(
        ranked.withColumn("__fraction", fraction)
        .withColumn("__slice", F.floor(F.col("__fraction") * SLICES))
        .drop("__order", "__rank", "__rank_total"),
        "interleaved",
    )
    counts = spread.groupBy("__slice").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(  # SLICES rows at most, whatever the input
        "__slice",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
        F.sum("__n").over(Window.partitionBy(F.lit(1))).alias("__all"),
    )
    inside = Window.partitionBy("__slice").orderBy("__fraction", "__source")
    placed = spread.join(F.broadcast(starts), "__slice").withColumn(
        "__place", F.col("__start") + F.row_number().over(inside) - 1
    )
    sharded = placed.withColumn("shard", F.expr(f"cast(__place * {n_shards} div __all as int)"))
    slot = F.expr(f"__place - (cast(shard as long) * __all + {n_shards - 1}) div {n_shards}")
    return sharded.withColumn("slot", slot).select(
        *[F.col(f"`{c}`") for c in columns], "shard", "slot"
    )
