"""Slowly changing history (type 2) by comparing tracked columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from ledgermill.functions.calendar import AsOf, as_of_column
from ledgermill.operators.joins import as_of_join
from ledgermill.operators.merge import fs_exists, read_mart, rebuild_mart
from ledgermill.session import staged

VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"

# Key and tracked columns of the product price history.
PRICE_KEY = "product_id"
PRICE_CHECK_COLUMNS = ("cost", "retail_price", "product_name", "category")


def empty_history(current: DataFrame) -> DataFrame:
    """A history without rows for ``current``."""
    interval = [StructField(name, TimestampType()) for name in (VALID_FROM, VALID_TO)]
    schema = StructType([*current.schema.fields, *interval])
    return current.sparkSession.createDataFrame([], schema)


def scd2_snapshot(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check_columns: tuple[str, ...],
    as_of: AsOf = None,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """History after a snapshot of ``current`` taken at ``as_of``.

    A change in a tracked column (NULL counts as a value) closes the open version and opens
    a new one; columns not tracked keep the value the version was opened with. A key that
    is gone closes its version. Closed versions pass through untouched and only open ones
    join, so the shuffle grows with the catalog and not with its history. Running the same
    snapshot again changes nothing.
    """
    now = as_of_column(as_of)
    columns = [c for c in history.columns if c not in (VALID_FROM, VALID_TO)]
    versions = [*columns, VALID_FROM, VALID_TO]
    closed = history.filter(F.col(VALID_TO).isNotNull()).select(versions)
    open_rows = history.filter(F.col(VALID_TO).isNull()).select(versions).alias("o")
    seen = current.select(columns).alias("c")
    same_key = F.col(f"o.{key}") == F.col(f"c.{key}")
    joined = open_rows.join(seen, same_key, "full_outer")

    is_open, is_seen = F.col(f"o.{key}").isNotNull(), F.col(f"c.{key}").isNotNull()
    changed = F.lit(False)
    for column in check_columns:
        changed = changed | ~F.col(f"o.{column}").eqNullSafe(F.col(f"c.{column}"))
    ends = (is_open & is_seen & changed) | (
        is_open & ~is_seen & F.lit(invalidate_hard_deletes)
    )
    begins = is_seen & (~is_open | changed)

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in columns]
        return F.struct(*fields, valid_from.alias(VALID_FROM), valid_to.alias(VALID_TO))

    kept = version(
        "o", F.col(f"o.{VALID_FROM}"), F.when(ends, now).otherwise(F.lit(None).cast("timestamp"))
    )
    opened = version("c", now, F.lit(None).cast("timestamp"))
    rows = F.array(F.when(is_open, kept), F.when(begins, opened))
    moved = joined.select(F.explode(rows).alias("v")).filter(F.col("v").isNotNull()).select("v.*")
    return closed.unionByName(moved)


def snapshot_prices(history: DataFrame | None, current: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The product price history after today's snapshot."""
    if history is None:
        history = empty_history(current)
    return scd2_snapshot(history, current, PRICE_KEY, PRICE_CHECK_COLUMNS, as_of)


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The history kept in ``path``: closed versions and the open ones; None before the first."""
    opened = read_mart(spark, f"{path}/open")
    if opened is None or not fs_exists(spark, f"{path}/closed"):
        return opened
    closed = spark.read.schema(opened.schema).parquet(f"{path}/closed/*")
    return closed.unionByName(opened)


def save_snapshot(
    spark: SparkSession,
    path: str,
    current: DataFrame,
    key: str,
    check_columns: tuple[str, ...],
    as_of: AsOf = None,
    invalidate_hard_deletes: bool = True,
) -> None:
    """Take a snapshot of ``current`` into the history kept in ``path``.

    Only open versions are read. Those that close are added in a folder of the snapshot's
    instant, and the open ones are written anew only if any closed or began: a day without
    changes writes nothing, and no day rewrites what was closed before. The closed rows come
    first and a repeated snapshot replaces its own folder, so one that was cut off is taken
    again.
    """
    opened = read_mart(spark, f"{path}/open")
    known = empty_history(current) if opened is None else opened
    after = scd2_snapshot(known, current, key, check_columns, as_of, invalidate_hard_deletes)
    now = as_of_column(as_of)
    moved = staged(after.withColumn("__begins", F.col(VALID_FROM).eqNullSafe(now)), "snapshot")
    ends = moved.filter(F.col(VALID_TO).isNotNull()).drop("__begins")
    begins = moved.filter("__begins")
    ended = not ends.isEmpty()
    if ended:
        stamp = spark.range(1).select(F.date_format(now, "yyyyMMdd'T'HHmmss.SSSSSS")).first()[0]
        ends.write.mode("overwrite").parquet(f"{path}/closed/{stamp}")
    if opened is None or ended or not begins.isEmpty():
        rebuild_mart(moved.filter(F.col(VALID_TO).isNull()).drop("__begins"), f"{path}/open")


def as_of_lookup(facts: DataFrame, history: DataFrame, key: str, instant: Column) -> DataFrame:
    """Point-in-time lookup of the version valid at ``instant``."""
    return as_of_join(facts, history, key, instant, VALID_FROM, VALID_TO)
