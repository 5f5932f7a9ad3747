"""Clustering along a Z-curve: the place of a row, and what a look-back reads."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.layout import DAY_BITS, clustered, z_value
from ledgermill.operators.merge import (
    current_path,
    generations,
    merge_mart,
    month_period,
    prune_generations,
    read_mart,
    rebuild_mart,
)
from ledgermill.operators.orders import Lookback
from ledgermill.session import stage_path
from ledgermill.sources import tables
from tests.conftest import rows

TIMES = ("created_at", "shipped_at", "returned_at")
LAST = 1 << DAY_BITS


def place(*days):
    """The interleaved bits of day numbers, in plain Python."""
    value = 0
    for position, day in enumerate(days):
        number = 0 if day is None else min(max((day - date(1970, 1, 1)).days, 0), LAST - 1)
        for bit in range(DAY_BITS):
            value |= (number >> bit & 1) << (bit * len(days) + position)
    return value


def test_places(frame):
    given = [
        ("2024-06-30 23:59:59", "1970-01-01 00:00:00", None),
        ("1969-12-31 00:00:00", "2059-09-19 00:00:00", "2200-01-01 00:00:00"),
        (None, None, None),
        ("2001-08-01 00:00:00", "2001-08-02 00:00:00", "2001-08-03 00:00:00"),
    ]
    df = frame(", ".join(f"{t} timestamp" for t in TIMES), *given)
    expected = [place(*[v and date.fromisoformat(v[:10]) for v in row]) for row in given]
    assert sorted(r[0] for r in df.select(z_value(TIMES)).collect()) == sorted(expected)
    assert [r[0] for r in frame("t timestamp", ("1970-01-08 05:00:00",))
            .select(z_value(["t"])).collect()] == [7]
    for wrong in ((), TIMES + ("a", "b")):
        with pytest.raises(ValueError, match="Z-curve"):
            z_value(wrong)


def facts(spark, n=40000):
    """Two years of items in no order; most are never returned, a third lacks all times."""
    dated = F.col("id") % 3 != 0
    seconds = F.pmod(F.xxhash64("id"), F.lit(2 * 365 * 86400))
    created = F.timestamp_seconds(F.lit(1640995200) + seconds)
    later = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(20 * 86400))
    back = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(300 * 86400))
    return spark.range(0, n, 1, 8).select(
        "id",
        F.when(dated, created).alias("created_at"),
        F.when(dated, F.timestamp_seconds(F.unix_seconds(created) + later)).alias("shipped_at"),
        F.when(dated & (F.col("id") % 7 == 1),
               F.timestamp_seconds(F.unix_seconds(created) + back)).alias("returned_at"),
    )


def rows_scanned(df) -> int:
    """Rows that leave the scan of ``df``'s one table, row groups skipped by statistics not."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture
def unplanned(spark):
    """Adaptive execution off, so that the scan is the leaf of the plan."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("recent", TIMES)
def test_a_window_of_any_time_skips_files(spark, unplanned, recent):
    df = facts(spark)
    plain, laid_out = stage_path(spark, "plain"), stage_path(spark, "laid-out")
    tables.append_parquet(df.repartition(24), plain)
    tables.append_parquet(df, laid_out, cluster_by=TIMES)
    window = (F.col(recent) >= "2022-05-01") & (F.col(recent) < "2022-05-15")
    before = spark.read.schema(df.schema).parquet(plain).filter(window)
    after = spark.read.schema(df.schema).parquet(laid_out).filter(window)
    assert rows(after) == rows(before) and after.count() > 0
    assert rows_scanned(before) == 40000
    assert rows_scanned(after) < 40000 * 0.6


def test_a_lookback_over_three_times_skips_files(spark, unplanned):
    df, laid_out = facts(spark), stage_path(spark, "laid-out")
    tables.append_parquet(df, laid_out, cluster_by=TIMES)
    recent = Lookback("2024-08-01 00:00:00", 14).touched(*TIMES)
    kept = spark.read.schema(df.schema).parquet(laid_out).filter(recent)
    assert rows(kept) == rows(df.filter(recent)) and kept.count() > 0
    assert rows_scanned(kept) < 40000 * 0.5


def test_rows_without_times_do_not_fill_one_task(spark, unplanned):
    laid_out = clustered(facts(spark), TIMES)
    sizes = [r["count"] for r in laid_out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40000 and max(sizes) < 3 * 40000 / 24


def test_marts_keep_their_layout(spark):
    """Rebuilt and merged files are sorted along the curve, and hold the rows they should."""
    mart, period = stage_path(spark, "mart"), month_period("created_at")
    old, new = facts(spark, 3000), facts(spark, 3300).filter("id >= 2900")
    rebuild_mart(old, mart, period, TIMES)
    merge_mart(spark, mart, new, "id", period, TIMES)
    folder = current_path(spark, mart)
    found = spark.read.schema(old.schema).parquet(folder)
    assert rows(found, *old.columns) == rows(facts(spark, 3300))
    at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    placed = found.select(*at, z_value(TIMES).alias("z")).collect()
    files = {}
    for path, index, z in placed:
        files.setdefault(path, []).append((index, z))
    for held in files.values():
        places = [z for _, z in sorted(held)]
        assert places == sorted(places)


def test_old_generations_go(spark, frame):
    """The newest ones stay and merge on; the locator of a deleted one goes with it."""
    mart = stage_path(spark, "mart")
    assert prune_generations(spark, mart) == []
    for amount in (1.0, 2.0, 3.0):
        rebuild_mart(frame("id string, amount double", ("a", amount)), mart)
        merge_mart(spark, mart, frame("id string, amount double", ("b", amount)), "id")
    names = generations(spark, mart)
    assert prune_generations(spark, mart, 3) == [] and len(names) == 3
    assert prune_generations(spark, mart, 2) == names[:1]
    assert generations(spark, mart) == names[1:]
    assert not tables.path_exists(spark, f"{mart}/keys-00000001")
    assert tables.path_exists(spark, f"{mart}/keys-00000003")
    merge_mart(spark, mart, frame("id string, amount double", ("b", 9.0)), "id")
    assert prune_generations(spark, mart, 1) == names[1:2]
    assert rows(read_mart(spark, mart)) == [("a", 3.0), ("b", 9.0)]
    with pytest.raises(ValueError, match="at least one"):
        prune_generations(spark, mart, 0)
