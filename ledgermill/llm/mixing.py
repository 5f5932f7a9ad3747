"""Mixing sources to target weights by Sainte-Laguë apportionment.

Blocks of equal size are the seats: each goes to the source with the highest quotient of
target over ``2 * seats + 1``. The blocks of the first shards are the seats of a smaller
house, so every shard gets an integer quota of each source. A source's texts in seeded order
are its blocks; a quota beyond one pass over them starts the next pass.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.ranks import with_running_sum
from ledgermill.llm.text import WORD_PATTERN, md5_text, small_table
from ledgermill.session import staged

MAX_REPEATS = 3
BLOCK_WORDS = 16
BROADCAST_SOURCES = 20_000  # a row of about 400 bytes each; beyond, Spark picks the join


@dataclass(frozen=True)
class SourcePlan:
    source: str | None
    words: int
    target: float
    blocks: int  # seats in the whole house
    shards: tuple[int, ...]  # blocks up to and with each shard


def capped_targets(sizes: list[int], weights: list[float], repeats: float) -> list[float]:
    """All words shared out by weight; what exceeds ``repeats`` sizes is shared out again."""
    targets = [0.0] * len(sizes)
    open_ = [i for i, size in enumerate(sizes) if size]
    left = float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > repeats * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(repeats * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def apportion(targets: list[float], seats: int) -> list[int]:
    """Sainte-Laguë: the ``seats`` highest quotients, ties to the earlier source.

    A divisor high enough to stay below ``seats`` hands out all but about one seat per source
    at once; the rest go one by one.
    """
    total = sum(targets)
    if not total:
        return [0] * len(targets)
    given = [0] * len(targets)
    sure = seats - len(targets)
    if sure > 0:
        given = [int(t * sure / total + 0.5) for t in targets]
    heap = [(-t / (2 * g + 1), i) for i, (t, g) in enumerate(zip(targets, given, strict=True)) if t]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        _, i = heap[0]
        given[i] += 1
        heapq.heapreplace(heap, (-targets[i] / (2 * given[i] + 1), i))
    return given


def plan_sources(
    totals: list[tuple[str | None, int]], n_shards: int, block_words: int, repeats: int
) -> list[SourcePlan]:
    """Sources by code point, null last, weigh 1, 2, 3, 1, 2, 3, ..."""
    ordered = sorted(totals, key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [words for _, words in ordered]
    targets = capped_targets(sizes, [1 + i % 3 for i in range(len(sizes))], repeats)
    house = round(sum(sizes) / block_words)
    steps = [apportion(targets, house * (h + 1) // n_shards) for h in range(n_shards)]
    return [
        SourcePlan(name, size, target, steps[-1][i], tuple(s[i] for s in steps))
        for i, ((name, size), target) in enumerate(zip(ordered, targets, strict=True))
    ]


def mix_sources(
    docs: DataFrame, n_shards: int = 40, id_column: str = "doc_id", text_column: str = "text",
    source_column: str = "source", seed: int = 0, block_words: int = BLOCK_WORDS,
    repeats: int = MAX_REPEATS, key_column: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, shard.

    ``size`` counts words (runs without ASCII white space; null and empty texts have none).
    ``taken`` counts the words that the mix takes of the document, repeats included: whole
    passes over its source plus the part that the last, partial pass reaches. ``shard`` is
    the shard of the first word taken, null if none is. Repeated rows and ids count as
    documents of their own; ``key_column``, unique per row, is passed through and orders them.
    Only one row per source reaches the driver: names and totals.
    """
    spark = docs.sparkSession
    key = [key_column] if key_column else []
    source = F.col(source_column).cast("string")
    light = staged(
        docs.select(
            F.col(id_column).alias("doc_id"),
            source.alias("source"),
            F.coalesce(F.regexp_count(text_column, F.lit(WORD_PATTERN)), F.lit(0))
            .cast("long")
            .alias("size"),
            *key,
        ).select(
            "*",
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("__source"),
            md5_text(F.lit(seed), F.col("doc_id"), F.col("size")).alias("__order"),
        ),
        "sizes",
    )
    totals = light.groupBy("source").agg(F.sum("size").alias("words")).collect()
    plans = plan_sources([(r.source, r.words) for r in totals], n_shards, block_words, repeats)
    rows = [
        (
            "null" if p.source is None else f"={p.source}",
            p.words,
            p.target,
            min(p.blocks * block_words, repeats * p.words),
            list(p.shards),
        )
        for p in plans
    ]
    fields = {"__source": pa.string(), "source_size": pa.int64(), "target": pa.float64()}
    fields |= {"quota": pa.int64(), "steps": pa.list_(pa.int64())}
    quotas = small_table(spark, rows, fields)
    if len(rows) <= BROADCAST_SOURCES:
        quotas = F.broadcast(quotas)
    placed = with_running_sum(
        light, "__source", "__order", ["doc_id", "size", *key], F.col("size"), "__at"
    ).join(quotas, "__source")
    passes = F.expr("case when source_size > 0 then quota div source_size else 0 end")
    rest = F.expr("case when source_size > 0 then quota % source_size else 0 end")
    partly = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__at")))
    block = F.expr(f"__at div {block_words}")
    shard = F.size(F.filter("steps", lambda s: s <= block))
    return placed.withColumn("taken", F.col("size") * passes + partly).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "taken",
        F.when(F.col("taken") > 0, F.least(shard, F.lit(n_shards - 1))).cast("int").alias("shard"),
        *key,
    )
