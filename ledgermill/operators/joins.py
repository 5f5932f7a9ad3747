"""Joins that keep their balance when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.session import staged

_SPREAD = "__null_spread"
HOT_SHARE = 1 / 64  # of the rows: keys with more are dealt over several tasks
HOT_ROWS = 100_000
TRACKED = 1024  # keys in the sketch that finds them
SALTS = 64
SPREADS = 1024  # numbers of rows without a hot key: small ones compress in a shuffle
SLICE_ROWS = 4_000_000  # facts and versions of one key that one task orders
MOST_SLICES = 1024  # of one key


def _null_spread(columns: list[str], key: str, side: str = "") -> Column:
    """Number rows by their key, or without one by their content: the same on every attempt.

    The number of a keyed row depends on its key, not on a constant, which the optimizer
    would fold out of the join keys where a key cannot be NULL.
    """
    by_content = F.pmod(F.xxhash64(*[F.col(f"{side}{c}") for c in columns]), F.lit(SPREADS))
    by_key = F.pmod(F.xxhash64(F.col(f"{side}{key}")), F.lit(SPREADS))
    return F.when(F.col(f"{side}{key}").isNull(), by_content).otherwise(by_key)


def full_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer equi-join of two frames that hold about one row per key.

    Adaptive execution never splits a full outer join, and rows without a key all hash to
    one partition although they can match nothing. A content hash in the join condition
    deals them out over the partitions. Column names must not clash.
    """
    same_key = F.col(f"l.{left_key}") == F.col(f"r.{right_key}")
    same_spread = _null_spread(left.columns, left_key, "l.") == _null_spread(
        right.columns, right_key, "r."
    )
    joined = left.alias("l").join(right.alias("r"), same_key & same_spread, "full_outer")
    return joined.select(
        *[F.col(f"l.{c}").alias(c) for c in left.columns],
        *[F.col(f"r.{c}").alias(c) for c in right.columns],
    )


def hot_keys(rows: DataFrame, key: str) -> list:
    """Keys that hold more than ``HOT_SHARE`` of the rows and ``HOT_ROWS`` of them at least.

    One pass over the key with a sketch of the most frequent ones; its counts are at most
    3.5 / ``TRACKED`` of the rows too high and never too low, so that no hot key is missed and
    every key listed occurs.
    """
    listed = f"approx_top_k({key}, {2 * int(1 / HOT_SHARE)}, {TRACKED})"
    found = rows.filter(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(listed).alias("top")
    ).first()
    least = max(HOT_ROWS, found["rows"] * HOT_SHARE)
    return sorted(top["item"] for top in found["top"] or [] if top["count"] > least)


def full_outer_many_to_one(
    many: DataFrame, one: DataFrame, many_key: str, one_key: str
) -> DataFrame:
    """Full outer equi-join where ``many`` may repeat a key any number of times.

    Both sides are read once and meet in one shuffle, which also tells the rows of ``one``
    that find nothing. Adaptive execution cannot split a full outer join, so keys carry a
    number: the rows of a hot key are dealt by content over ``SALTS`` numbers, each with a
    copy of its rows of ``one``. A hot key occurs, hence copies left alone are dropped. Rows
    without a key match nothing and are dealt out by content.
    """
    hot = hot_keys(many, many_key)
    if not hot:
        return full_outer(many, one, many_key, one_key)
    by_content = F.pmod(F.xxhash64(*many.columns), F.lit(SALTS))
    spread = _null_spread(many.columns, many_key)
    left = many.withColumns(
        {
            _SPREAD: F.when(F.col(many_key).isin(hot), by_content).otherwise(spread),
            "__present": F.lit(True),
        }
    )
    every = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    spread = F.array(_null_spread(one.columns, one_key))
    copies = F.when(F.col(one_key).isin(hot), every).otherwise(spread)
    right = one.withColumn(_SPREAD, F.explode(copies))
    same_key = F.col(f"l.{many_key}") == F.col(f"r.{one_key}")
    same_spread = F.col(f"l.{_SPREAD}") == F.col(f"r.{_SPREAD}")
    joined = left.alias("l").join(right.alias("r"), same_key & same_spread, "full_outer")
    alone = F.col("__present").isNull() & F.col(f"r.{one_key}").isin(hot)
    joined = joined.filter(~F.coalesce(alone, F.lit(False)))
    return joined.select(
        *[F.col(f"l.{c}").alias(c) for c in many.columns],
        *[F.col(f"r.{c}").alias(c) for c in one.columns],
    )


def valid_at(instant: Column, valid_from: Column, valid_to: Column) -> Column:
    """Half-open validity interval; an open end is NULL."""
    return (instant >= valid_from) & (valid_to.isNull() | (instant < valid_to))


def _slices_of(events: DataFrame, slice_rows: int) -> DataFrame | None:
    """(__key, __cuts): the instants that cut keys of more than ``slice_rows`` rows into
    slices of about that size; None without such a key."""
    events = staged(events, "events")  # read for the counts and for the cuts
    counts = events.groupBy("__key").agg(F.count(F.lit(1)).alias("__rows"))
    heavy = staged(counts.filter(F.col("__rows") > slice_rows), "heavy-keys")
    most = heavy.agg(F.max("__rows")).first()[0]
    if most is None:
        return None
    parts = min(MOST_SLICES, -(-most // slice_rows))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = F.percentile_approx("__at", shares, 10 * parts)
    wanted = F.least(F.lit(parts), F.ceil(F.first("__rows") / slice_rows)).cast("int")
    step = F.sequence(F.lit(1), wanted - 1)
    found = events.join(heavy, "__key").groupBy("__key").agg(cuts.alias("all"), step.alias("steps"))
    thinned = F.transform("steps", lambda i: F.element_at("all", F.ceil(i * parts / (F.size("steps") + 1)).cast("int")))
    return staged(found.select("__key", F.array_sort(F.array_distinct(thinned)).alias("__cuts")), "cuts")


def _cuts_passed() -> Column:
    """How many of the ascending ``__cuts`` are at or before ``__at``, found by halving."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(MOST_SLICES.bit_length()))])

    def further(passed: Column, step: Column) -> Column:
        ahead = F.try_element_at("__cuts", passed + step) <= F.col("__at")
        return F.when(ahead, passed + step).otherwise(passed)

    return F.aggregate(steps, F.lit(0), further)


def _carried_in(versions: DataFrame, cuts: DataFrame) -> DataFrame:
    """The version each slice starts with: the last one that began in a slice before it."""
    last = versions.groupBy("__key", "__slice").agg(F.max_by("__version", F.struct("__at", "__rank")).alias("v"),
                                                    F.max("__at").alias("__at"))
    every = cuts.select("__key", F.explode(F.sequence(F.lit(0), F.size("__cuts"))).alias("__slice"))
    before = (
        Window.partitionBy("__key").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = every.join(last, ["__key", "__slice"], "left_outer").select(
        "__key",
        "__slice",
        F.last("v", ignorenulls=True).over(before).alias("__version"),
        F.last("__at", ignorenulls=True).over(before).alias("__at"),
    )
    return seen.filter(F.col("__version").isNotNull())


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    instant: Column,
    valid_from: str = "dbt_valid_from",
    valid_to: str = "dbt_valid_to",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Left join of each fact to the version of ``key`` valid at ``instant``.

    A sweep, not a join: facts and versions are ordered together by key and instant, and one
    pass carries the last version begun to the facts behind it. A key of more than
    ``slice_rows`` rows is cut into slices of time, and a small table tells the version each
    slice starts with, so a key's facts and versions may both be many. Facts without a key or
    an instant are dealt out by content. The versions of a key must not overlap, as a history
    of type 2 guarantees; of overlapping ones the last begun counts. Columns of the history
    other than the key and the interval are added to the facts.
    """
    carried = [c for c in history.columns if c not in (key, valid_from, valid_to)]
    begun, ended = F.col(valid_from), F.col(valid_to)
    open_end = F.struct(ended.isNull().alias("open"), ended.alias("end"))  # of equal starts, the open one
    versions = staged(
        history.filter(F.col(key).isNotNull() & begun.isNotNull()).select(
            F.col(key).alias("__key"),
            begun.cast("timestamp").alias("__at"),
            open_end.alias("__rank"),
            F.struct(ended.cast("timestamp").alias("__end"), *carried).alias("__version"),
        ),
        "versions",
    )
    rows = facts.select(
        F.col(key).cast(history.schema[key].dataType).alias("__key"),
        instant.cast("timestamp").alias("__at"),
        F.struct(*facts.columns).alias("__fact"),
    )
    events = rows.select("__key", "__at").filter("__key is not null and __at is not null")
    cuts = _slices_of(events.unionByName(versions.select("__key", "__at")), slice_rows)
    if cuts is None:
        rows, versions = (side.withColumn("__slice", F.lit(0)) for side in (rows, versions))
    else:
        place = _cuts_passed()
        rows, versions = (
            side.join(cuts, "__key", "left_outer").withColumn("__slice", place).drop("__cuts")
            for side in (rows, versions)
        )
        versions = versions.unionByName(_carried_in(versions, cuts), allowMissingColumns=True)
    unmatched = F.col("__key").isNull() | F.col("__at").isNull()
    aside = -1 - F.pmod(F.xxhash64("__fact"), F.lit(SALTS)).cast("int")
    rows = rows.withColumn("__slice", F.when(unmatched, aside).otherwise(F.col("__slice")))
    both = versions.withColumn("__kind", F.lit(0)).unionByName(
        rows.withColumn("__kind", F.lit(1)), allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy("__key", "__slice")
        .orderBy("__at", "__kind", "__rank")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = both.withColumn("__version", F.last("__version", ignorenulls=True).over(so_far))
    current = F.col("__version.__end").isNull() | (F.col("__at") < F.col("__version.__end"))
    return swept.filter("__kind = 1").select(
        "__fact.*", *[F.when(current, F.col("__version")[c]).alias(c) for c in carried]
    )
