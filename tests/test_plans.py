"""What the optimizer makes of the plans: pruning, pushdown, shuffles and skew."""

from __future__ import annotations

import random
import re
import time
from collections import Counter
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgermill.operators import inventory, joins, orders
from ledgermill.operators.joins import full_outer, full_outer_many_to_one
from ledgermill.operators.orders import Lookback
from ledgermill.operators.prefix import running_sums
from ledgermill.plans.daily import staged_sources
from ledgermill.schemas import RAW_TABLES
from ledgermill.session import CLEANUP_CONF, stage_path, staged
from ledgermill.sources import tables


@contextmanager
def conf(spark, **settings):
    named = {key.replace("__", "."): value for key, value in settings.items()}
    old = {key: spark.conf.get(key, None) for key in named}
    for key, value in named.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sources(spark, testbed):
    """The raw tables as files, with the long ids the schemas declare."""
    root = stage_path(spark, "plan-sources")
    for name, schema in RAW_TABLES.items():
        raw = testbed.raw(name)
        columns = [
            F.xxhash64(f.name).alias(f.name)
            if f.name in ("id", "inventory_item_id") and f.dataType.typeName() == "string"
            else F.col(f.name)
            for f in raw.schema.fields
        ]
        tables.append_parquet(raw.select(columns), f"{root}/{name}.parquet")
    return staged_sources(tables.load_all(spark, root))


def read_schemas(plan: str) -> list[set[str]]:
    found = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return [{field.split(":")[0] for field in text.split(",")} for text in found]


def test_projection_reaches_the_scan(sources):
    both = sources["raw_order_items"].unionByName(sources["incr_order_items"])
    aggregated = orders.aggregate_order_items(both).select("order_id", "total_order_amount")
    for columns in read_schemas(physical(aggregated)):
        assert columns == {"order_id", "user_id", "sale_price"}


def test_lookback_reaches_the_scan(sources):
    lookback = Lookback("2001-08-01 00:00:00")
    recent = orders.order_item_revenue(
        sources["raw_order_items"], sources["raw_products"], lookback
    )
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", physical(recent))
    assert any(
        text.startswith("Or(") and text.count("2001-07-18") == 3 for text in pushed
    ), pushed


def test_item_aggregate_shuffles_once(sources):
    both = sources["raw_order_items"].unionByName(sources["incr_order_items"])
    assert physical(orders.aggregate_order_items(both)).count("Exchange hashpartitioning") == 1


def test_units_meet_in_one_shuffle(spark, sources):
    """Receipts and lines are each read and shuffled once, and one join sees both."""
    units = inventory.join_units(sources["raw_inventory_items"], sources["raw_order_items"])
    plan = physical(units)
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 2
    assert plan.count("Join ") == 1 and "FullOuter" in plan


@pytest.mark.parametrize("hot", ["7", None])
def test_a_hot_unit_is_split(spark, monkeypatch, hot):
    """A third of all lines points at one unit, or at none."""
    monkeypatch.setattr(joins, "HOT_ROWS", 1000)
    many = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id").cast("string")).alias("k"),
        F.xxhash64("id").alias("amount"),
    )
    one = spark.range(0, 60000, 1, 8).select(
        F.col("id").cast("string").alias("unit"), F.xxhash64("id").alias("cost")
    )
    assert joins.hot_keys(many, "k") == ([hot] if hot else [])
    with conf(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="50"):
        joined = full_outer_many_to_one(many, one, "k", "unit")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        counts = joined.agg(F.count("k"), F.count("unit"), F.count(F.lit(1))).first()
    assert max(sizes) < 4 * sum(sizes) / len(sizes)
    keys = {str(i) for i in range(60000) if i % 3} | ({hot} if hot else set())
    matched = 40000 + (20000 if hot else 0)
    unmatched = 60000 - len(keys)
    lines = 60000
    assert tuple(counts) == (matched, matched + unmatched, lines + unmatched)


def test_full_outer_equals_the_join(spark, monkeypatch):
    """Repeated and missing keys on both sides, with and without hot keys."""
    many = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 4), ("z", None)], "k string, x int"
    )
    one = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("c", 3.0), (None, 4.0), ("z", None)], "u string, y double"
    )
    expected = Counter(map(tuple, many.join(one, F.col("k") == F.col("u"), "full_outer").collect()))
    for least in (100_000, 1):
        monkeypatch.setattr(joins, "HOT_ROWS", least)
        found = full_outer_many_to_one(many, one, "k", "u")
        assert found.columns == ["k", "x", "u", "y"]
        assert Counter(map(tuple, found.collect())) == expected
    nothing = full_outer_many_to_one(many.limit(0), one, "k", "u")
    assert nothing.count() == 5 and nothing.filter("k is not null").count() == 0


def plain_as_of(facts, history):
    found = []
    for key, at, x in facts:
        valid = [v for k, start, end, v in history
                 if key is not None and at is not None and k == key and start <= at and (end is None or at < end)]
        found += [(key, at, x, v) for v in valid or [None]]
    return Counter(found)


@pytest.mark.parametrize("slice_rows", [1_000_000, 50, 7])
def test_as_of_sweep_equals_plain_python(spark, slice_rows):
    """A key with most of the facts and versions, facts at the instants of versions, gaps."""
    chance = random.Random(slice_rows)
    day = lambda n: datetime(2020, 1, 1) + timedelta(hours=n)
    history, facts = [], []
    for key, n in (("hot", 120), ("cold", 2), ("never sold", 1)):
        cuts = sorted(chance.sample(range(1000), 2 * n))
        for start, end in zip(cuts[::2], cuts[1::2], strict=True):
            history.append((key, day(start), day(end), start))
    history += [("hot", day(1000), None, 1000), ("cold", day(900), None, None)]
    for i in range(400):
        facts.append((chance.choice(["hot"] * 6 + ["cold", "none", None]), chance.choice([day(chance.randrange(1100)), None, day(500)]), i))
    versions = spark.createDataFrame(history, "k string, valid_from timestamp, valid_to timestamp, v int")
    rows = spark.createDataFrame(facts, "k string, at timestamp, x int").repartition(5)
    found = joins.as_of_join(rows, versions, "k", F.col("at"), "valid_from", "valid_to", slice_rows)
    assert found.columns == ["k", "at", "x", "v"]
    assert Counter(map(tuple, found.collect())) == plain_as_of(facts, history)
    empty = joins.as_of_join(rows, versions.limit(0), "k", F.col("at"), "valid_from", "valid_to", slice_rows)
    assert empty.count() == 400 and empty.filter("v is not null").count() == 0


def test_as_of_sweep_joins_no_versions(spark):
    """Half of all facts of one product with 10,000 versions: no join in the plan but that
    with the few cuts, and no task with much more than its share."""
    facts = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit("p")).otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_seconds(F.col("id") * 7).alias("at"),
    )
    versions = spark.range(0, 10_000, 1, 8).select(
        F.lit("p").alias("k"),
        F.timestamp_seconds(F.col("id") * 28).alias("valid_from"),
        F.timestamp_seconds(F.col("id") * 28 + 28).alias("valid_to"),
        F.col("id").alias("v"),
    )
    whole = joins.as_of_join(facts, versions, "k", F.col("at"), "valid_from", "valid_to")
    assert "Join" not in physical(whole)
    with conf(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="20"):
        swept = joins.as_of_join(facts, versions, "k", F.col("at"), "valid_from", "valid_to", 1000)
        sizes = [r["count"] for r in swept.groupBy(F.spark_partition_id()).count().collect()]
        assert swept.filter("k = 'p' and v = floor(unix_seconds(at) / 28)").count() == 20_000
    assert max(sizes) < 4 * sum(sizes) / len(sizes)


def test_running_sums_equal_a_window(spark):
    rows = spark.range(0, 3000, 1, 4).select(
        F.date_add(F.lit("1960-01-01"), (F.col("id") * 13 % 9001).cast("int")).alias("day"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 4).alias("g"),
        F.when(F.col("id") % 11 > 0, F.col("id").cast("decimal(20,2)")).alias("x"),
    )
    for group in ([], ["g"]):
        daily = rows.groupBy(*group, "day").agg(F.sum("x").alias("x"))
        order = Window.partitionBy(*group).orderBy("day")
        expected = daily.select(
            *group, "day", F.sum("x").over(order).alias("running_x"), F.lead("day").over(order).alias("next_day")
        )
        found = running_sums(daily, group, "day", ["x"]).select(expected.columns)
        assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))
    assert running_sums(daily.limit(0), group, "day", ["x"]).count() == 0


def test_rows_without_a_key_are_spread(spark):
    left = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") < 0, F.col("id").cast("string")).alias("a"), F.col("id").alias("x")
    )
    right = spark.range(0, 10, 1, 2).select(F.col("id").cast("string").alias("b"))
    with conf(spark, spark__sql__adaptive__enabled="false",
              spark__sql__autoBroadcastJoinThreshold="-1"):
        joined = full_outer(left, right, "a", "b")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 4010
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_the_hot_product_is_counted_before_the_shuffle(spark, sources):
    """A third of all units of one product leave each task as a few cells."""
    from ledgermill.operators.fiscal import unit_cells

    units = spark.range(0, 30000, 1, 4).select(
        F.lit("p").alias("product_id"),
        *[F.lit("x").alias(c) for c in ("product_name", "product_category", "product_brand")],
        F.lit(2020).alias("inbound_fiscal_year"),
        F.lit(None).cast("int").alias("outbound_fiscal_year"),
        F.lit(1.0).alias("historical_unit_cost"),
        F.lit(2.0).alias("current_market_price"),
        F.col("id").cast("string").alias("inventory_item_id"),
        F.lit(None).cast("double").alias("sale_price"),
        F.lit("2020-01-01").cast("timestamp").alias("inbound_at"),
    )
    cells = unit_cells(units)
    plan = final_plan(cells)
    assert cells.first().units == 30000
    assert re.search(r"HashAggregate.*partial_count", plan)


def test_slices_are_found_by_halving(spark):
    """The number of cuts at or before an instant, in steps that grow with its logarithm."""
    frame = spark.range(-5, 300).selectExpr(
        "timestamp_seconds(id) __at", "transform(sequence(0, 999), i -> timestamp_seconds(i * 2 / 7)) __cuts"
    )
    linear = F.size(F.filter("__cuts", lambda cut: cut <= F.col("__at")))
    assert frame.filter(joins._cuts_passed() != linear).count() == 0
    gaps = spark.sql("select cast(null as array<timestamp>) __cuts, now() __at union all "
                     "select array(now()), cast(null as timestamp)")
    assert [r[0] for r in gaps.select(joins._cuts_passed()).collect()] == [0, 0]


def test_lines_are_joined_before_their_texts(testbed):
    """No text that a line's numbers give is shuffled with them."""
    plan = physical(testbed.all_inventory_items.hint("merge"))
    first = re.search(r"concat_ws", plan).start()
    assert first < plan.index("Join ")


def test_merged_partitions_stay_small(testbed):
    """Sessions that the library configures merge shuffled partitions up to 32 MB."""
    assert testbed.spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"


def test_a_staged_frame_leaves_no_shuffle(spark):
    """The files of the shuffles behind a staged frame are deleted once it is written."""
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.length())
                if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    counted = spark.range(0, 5000, 1, 3).groupBy((F.col("id") % 700).alias("k")).count()
    kept = staged(counted, "counted")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)  # they are deleted in the background
    assert not shuffled() - before
    assert kept.agg(F.sum("count")).first()[0] == 5000
    assert spark.conf.get(CLEANUP_CONF, None) is None
    assert counted.count() == 700 and counted.count() == 700
