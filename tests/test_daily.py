from __future__ import annotations

from datetime import datetime

import pytest

from ledgermill.operators import orders
from ledgermill.operators.controls import unexpected_order_variance
from ledgermill.operators.merge import generations, read_mart
from ledgermill.operators.scd2 import read_history
from ledgermill.operators.orders import Lookback
from ledgermill.plans import daily
from ledgermill.schemas import RAW_TABLES
from ledgermill.session import stage_path
from ledgermill.sources import tables
from ledgermill.sources.testbed import TEST_TABLES
from ledgermill.streaming.upsert import file_stream, stream_upsert, touched_orders
from tests.conftest import rows

SATURDAY, SUNDAY = datetime(2024, 6, 29, 9), datetime(2024, 6, 30, 9)


def sources(frame, root):
    old, new = "2024-01-10 00:00:00", "2024-06-28 00:00:00"
    given = {
        "raw_orders": [(1, 1, "Complete", "F", old, None, old, old, 1)],
        "raw_order_items": [(1, 1, 1, 1, 1, "Complete", old, old, old, None, 20.0)],
        "raw_products": [(1, 5.0, "Socks", "n", "b", 20.0, "Men", "s", 1)],
        "raw_users": [(1, "F", "L", "e@x", 30, "F", *[None] * 9, None)],
        "raw_inventory_items": [(1, 1, old, old, 5.0, "Socks", "n", "b", 20.0, "Men", "s", 1)],
        "incr_orders": [(-1, 1, "Shipped", "F", new, None, new, None, 2)],
        "incr_order_items": [(-1, -1, 1, 1, -1, "Shipped", new, new, None, None, 30.0)],
        "incr_inventory_items": [
            (-1, 1, "2024-06-01 00:00:00", None, 5.0, "Socks", "n", "b", 20.0, "Men", "s", 1)
        ],
    }
    for name, values in given.items():
        if name == "raw_users":
            values = [v[:6] + (None,) * 10 for v in values]
        tables.append_parquet(frame(RAW_TABLES[name], *values), f"{root}/{name}.parquet")


@pytest.fixture
def folders(spark, frame):
    root = stage_path(spark, "sources")
    sources(frame, root)
    return root, stage_path(spark, "warehouse")


def test_daily_runs(spark, frame, folders):
    source_root, root = folders
    # The new order has two items in its header and one line: a control fails and nothing
    # leaves until the caller insists.
    with pytest.raises(daily.ExportBlocked, match="unexpected_order_variance"):
        daily.run(spark, source_root, root, SATURDAY, export_dir=f"{root}/export")
    assert not tables.path_exists(spark, f"{root}/export")
    first = daily.run(
        spark, source_root, root, SATURDAY, export_dir=f"{root}/export", force=True
    )
    assert rows(first.controls, "test_name", "status") == [
        ("lead_time_above_baseline", "pass"),
        ("unexpected_order_variance", "fail"),
        ("unsuccessful_reconciliation", "pass"),
        ("wrong_revenue_recognition", "pass"),
    ]
    assert rows(first.freshness, "source", "status") == [
        ("incr_order_items", "warn"), ("incr_orders", "warn"),
    ]
    results = {(r.table_name, r.test_name): r for r in first.constraints.collect()}
    assert len(results) == 163
    assert {r.status for r in results.values()} == {"pass"}
    revenue = rows(first.marts["revenue"], "order_id", "recognized_revenue")
    assert revenue == [("-1", 30.0), ("1", 20.0)]
    exported = spark.read.csv(f"{root}/export/revenue", header=True)
    assert rows(exported, "order_id") == [("-1",), ("1",)]

    # A late return of the new order and a backdated correction of the old one arrive.
    late = "2024-06-29 00:00:00"
    tables.append_parquet(
        frame(RAW_TABLES["incr_order_items"],
              (-2, -1, 1, 1, -2, "Returned", late, late, None, late, 7.0),
              (-3, 1, 1, 1, -3, "Complete", "2024-01-11 00:00:00", None, None, None, 3.0)),
        f"{source_root}/incr_order_items.parquet",
    )
    second = daily.run(spark, source_root, root, SATURDAY)
    assert rows(second.marts["refund_reconciliation"], "order_id", "gross_revenue") == [
        ("-1", 37.0), ("1", 20.0),
    ]
    assert rows(second.controls, "test_name", "failures") == [
        ("lead_time_above_baseline", 0),
        ("unexpected_order_variance", 0),
        ("unsuccessful_reconciliation", 0),
        ("wrong_revenue_recognition", 0),
    ]
    assert len(second.constraints.collect()) == 163
    assert ("-3",) not in rows(second.marts["order_item_revenue"], "order_item_id")
    third = daily.run(spark, source_root, root, SUNDAY, keep_generations=1)
    assert all(len(generations(spark, f"{root}/marts/{name}")) == 1 for name in daily.MARTS)
    assert rows(third.marts["refund_reconciliation"], "order_id", "gross_revenue") == [
        ("-1", 37.0), ("1", 23.0),
    ]
    history = read_history(spark, f"{root}/{daily.PRICE_HISTORY}")
    assert [str(r.dbt_valid_from) for r in history.collect()] == [str(SATURDAY)]


def test_controls_need_the_lines_of_suspects_only(spark, testbed):
    """Variances of any age are found without the whole sub-ledger."""
    sources = {n: testbed.staged(n) for n in ("raw_order_items", "incr_order_items")}
    reconciliation = testbed.order_reconciliation
    suspects = daily.suspect_subledger(sources, reconciliation)
    whole = unexpected_order_variance(reconciliation, testbed.aggregated)
    found = unexpected_order_variance(reconciliation, suspects)
    assert rows(found) == rows(whole) and whole.count() > 0
    assert 0 < suspects.count() < testbed.aggregated.count()


def test_merging_recent_rows_equals_a_rebuild(spark, testbed):
    """When everything older than the window is unchanged."""
    lookback = Lookback("2001-08-01 00:00:00", 14)
    whole = testbed.refund_reconciliation
    recent = orders.refund_reconciliation(testbed.aggregated, lookback)
    from ledgermill.operators.merge import upsert

    assert rows(upsert(whole, recent, "order_id")) == rows(whole)


def test_full_refresh_on_sundays():
    assert daily.is_full_refresh_day(SUNDAY) and not daily.is_full_refresh_day(SATURDAY)


def test_stream_in_several_batches(spark, testbed):
    folder, mart = stage_path(spark, "arrivals"), stage_path(spark, "mart")
    checkpoint = stage_path(spark, "checkpoint")
    lines = testbed.table("lineitem")
    lines.repartition(3, "l_partkey").write.parquet(folder)

    def model(batch):
        """Refunds of the orders touched, from all lines that have arrived."""
        arrived = spark.read.schema(TEST_TABLES["lineitem"]).parquet(folder)
        touched = touched_orders(
            tables_items(testbed, arrived), tables_items(testbed, batch)
        )
        return orders.refund_reconciliation(orders.aggregate_order_items(touched))

    def run():
        stream = file_stream(spark, folder, TEST_TABLES["lineitem"], per_batch=1)
        query = stream_upsert(stream, model, mart, "order_id", checkpoint)
        query.awaitTermination()
        return query.lastProgress

    run()
    expected = rows(testbed.refund_reconciliation)
    assert rows(read_mart(spark, mart, testbed.refund_reconciliation.schema)) == expected
    lines.limit(0).write.mode("append").parquet(folder)
    run()
    assert rows(read_mart(spark, mart, testbed.refund_reconciliation.schema)) == expected


def tables_items(testbed, lines):
    from ledgermill.sources.staging import stage_order_items

    return stage_order_items(testbed.order_items_of(lines))
