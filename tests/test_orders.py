from __future__ import annotations

from datetime import datetime

import pytest

from ledgermill.operators import controls, orders
from ledgermill.operators.orders import Lookback
from tests.conftest import rows

ITEMS = """order_item_id string, order_id string, user_id string, product_id string,
    inventory_item_id string, order_item_status string, sale_price double, created_at timestamp,
    shipped_at timestamp, delivered_at timestamp, returned_at timestamp"""
ORDERS = """order_id string, user_id string, order_status string, user_gender string,
    number_of_items long, created_at timestamp, returned_at timestamp, shipped_at timestamp,
    delivered_at timestamp"""
DAY = "2024-03-10 10:00:00"


def item(n, order, status, price=10.0, created=DAY, shipped=None, returned=None, user="u1"):
    return (str(n), order, user, "p1", f"i{n}", status, price, created, shipped, None, returned)


def header(order, status="complete", items=1, created=DAY, shipped=DAY, user="u1"):
    return (order, user, status, "f", items, created, None, shipped, None)


@pytest.fixture
def items(frame):
    return lambda *given: frame(ITEMS, *given)


@pytest.fixture
def ledgers(frame, items):
    def build(headers, lines):
        aggregated = orders.aggregate_order_items(items(*lines))
        return orders.join_master_subledger(frame(ORDERS, *headers), aggregated)

    return build


def test_status_lists(items):
    lines = items(
        item(1, "a", None),
        item(2, "b", "complete"),
        item(3, "b", "complete"),
        item(4, "c", "shipped"),
        item(5, "c", "complete"),
        item(6, "c", None),
    )
    found = rows(orders.aggregate_order_items(lines), "order_id", "order_item_status_list")
    assert found == [("a", None), ("b", "complete"), ("c", "complete,shipped")]


def test_aggregate_counts_amounts_and_refunds(items):
    lines = items(
        item(1, "a", "returned", 0.1, returned="2024-03-12 00:00:00"),
        item(2, "a", "returned", 0.2, returned="2024-03-15 00:00:00"),
        item(3, "a", "complete", 0.7, created="2024-03-09 00:00:00"),
    )
    row = orders.aggregate_order_items(lines).first()
    assert (row.subledger_item_count, row.returned_item_count) == (3, 2)
    assert (row.total_order_amount, row.refund_amount) == (1.0, 0.3)
    assert row.first_item_created_at == datetime(2024, 3, 9)
    assert row.last_refund_at == datetime(2024, 3, 15)


def test_one_order_with_two_users_stays_two_rows(items):
    lines = items(item(1, "a", "complete"), item(2, "a", "complete", user="u2"))
    assert orders.aggregate_order_items(lines).count() == 2


def test_existence_and_count_verdicts(ledgers):
    joined = ledgers(
        [header("ok"), header("missing"), header("short", items=3), header("nocount", items=None)],
        [item(1, "ok", "complete"), item(2, "orphan", "complete"), item(3, "short", "complete"),
         item(4, "nocount", "complete")],
    )
    found = rows(
        orders.order_reconciliation(joined),
        "order_id", "order_reconciliation", "order_item_count_recon",
    )
    assert found == [
        ("missing", orders.MISSING, orders.NOT_COMPARABLE),
        ("nocount", orders.RECONCILED, orders.VARIANCE),
        ("ok", orders.RECONCILED, orders.VERIFIED),
        ("orphan", orders.ORPHAN, orders.NOT_COMPARABLE),
        ("short", orders.RECONCILED, orders.VARIANCE),
    ]


def test_status_details_in_order_of_priority(ledgers):
    joined = ledgers(
        [header("same"), header("refund", items=2), header("ship", "shipped", 2),
         header("odd", "shipped"), header("null", None), header("nullsub")],
        [item(1, "same", "complete"), item(2, "refund", "complete"), item(3, "refund", "returned"),
         item(4, "ship", "complete"), item(5, "ship", "shipped"), item(6, "odd", "processing"),
         item(7, "null", "complete"), item(8, "nullsub", None)],
    )
    found = rows(
        orders.order_reconciliation(joined),
        "order_id", "order_status_recon", "order_status_recon_detail",
    )
    assert found == [
        ("null", orders.VARIANCE, orders.UNEXPLAINED),
        ("nullsub", orders.VARIANCE, orders.UNEXPLAINED),
        ("odd", orders.VARIANCE, orders.UNEXPLAINED),
        ("refund", orders.VARIANCE, orders.PARTIAL_REFUND),
        ("same", orders.VERIFIED, orders.VERIFIED),
        ("ship", orders.VARIANCE, orders.PARTIAL_SHIPMENT),
    ]


def test_cutoff_uses_calendar_months(ledgers):
    joined = ledgers(
        [header("in", created="2024-03-31 00:00:00", shipped="2024-03-31 23:59:59"),
         header("out", created="2024-03-31 23:59:59", shipped="2024-04-01 00:00:00"),
         header("wait", shipped=None)],
        [item(1, "in", "shipped"), item(2, "out", "shipped"), item(3, "wait", "processing")],
    )
    found = rows(
        orders.revenue(joined), "order_id", "cutoff_status", "gross_revenue", "recognized_revenue"
    )
    assert found == [
        ("in", orders.NORMAL, 10.0, 10.0),
        ("out", orders.CUTOFF_RISK, 10.0, 10.0),
        ("wait", orders.PENDING, 10.0, 0.0),
    ]


def test_refund_rates_and_types(items):
    lines = items(
        item(1, "none", "complete"),
        item(2, "full", "returned"),
        item(3, "part", "returned", 1.0),
        item(4, "part", "complete", 2.0),
        item(5, "free", "complete", 0.0),
        item(6, "freeback", "returned", 0.0),
    )
    found = rows(
        orders.refund_reconciliation(orders.aggregate_order_items(lines)),
        "order_id", "refund_value_rate", "refund_count_rate", "refund_type", "net_revenue",
    )
    assert found == [
        ("free", 0.0, 0.0, orders.NO_REFUND, 0.0),
        ("freeback", 0.0, 1.0, orders.FULLY_REFUNDED, 0.0),
        ("full", 1.0, 1.0, orders.FULLY_REFUNDED, 0.0),
        ("none", 0.0, 0.0, orders.NO_REFUND, 10.0),
        ("part", 0.3333, 0.5, orders.PARTIALLY_REFUNDED, 2.0),
    ]


def test_item_revenue_keeps_items_without_a_product(frame, items):
    products = frame(
        "product_id string, category string, brand string, name string", ("other", "x", "y", "z")
    )
    lines = items(item(1, "a", "complete", shipped=DAY), item(2, "a", "processing"))
    found = rows(
        orders.order_item_revenue(lines, products),
        "order_item_id", "product_category", "recognized_item_revenue",
    )
    assert found == [("1", None, 10.0), ("2", None, 0.0)]


def test_lookback_includes_its_first_instant(items):
    lines = items(
        item(1, "edge", "complete", created="2024-03-01 00:00:00"),
        item(2, "old", "complete", created="2024-02-29 23:59:59"),
        item(3, "late", "returned", created="2023-01-01 00:00:00", returned="2024-03-14 00:00:00"),
    )
    window = Lookback("2024-03-15 00:00:00", 14)
    recent = orders.refund_reconciliation(orders.aggregate_order_items(lines), window)
    assert rows(recent, "order_id") == [("edge",), ("late",)]


def test_header_without_lines_and_unshipped_needs_a_full_refresh(ledgers):
    joined = ledgers([header("new", created="2024-03-14 00:00:00", shipped=None)],
                     [item(1, "x", "complete", created="2020-01-01 00:00:00")])
    window = Lookback("2024-03-15 00:00:00", 14)
    assert orders.order_reconciliation(joined, window).count() == 0
    assert ("new",) in rows(orders.order_reconciliation(joined), "order_id")


def test_touched_ledgers_give_the_same_recent_rows(testbed):
    window = Lookback("2001-08-01 00:00:00", 14)
    headers, lines = orders.touched_ledgers(testbed.orders, testbed.order_items, window)
    aggregated = orders.aggregate_order_items(lines)
    joined = orders.join_master_subledger(headers, aggregated)
    assert 0 < lines.count() < testbed.order_items.count()
    for model, small, whole in (
        (orders.revenue, joined, testbed.joined),
        (orders.order_reconciliation, joined, testbed.joined),
        (orders.refund_reconciliation, aggregated, testbed.aggregated),
    ):
        expected = rows(model(whole, window))
        assert expected and rows(model(small, window)) == expected


def test_null_order_ids_meet_nothing(ledgers):
    joined = ledgers(
        [header(None), header(None)], [item(1, None, "complete"), item(2, None, "returned")]
    )
    found = rows(joined, "master_item_count", "subledger_item_count")
    assert found == [(1, None), (1, None), (None, 2)]


def test_controls_return_only_offenders(ledgers, items):
    joined = ledgers(
        [header("ok"), header("refund", items=2), header("odd", "shipped")],
        [item(1, "ok", "complete"), item(2, "refund", "complete"), item(3, "refund", "returned"),
         item(4, "odd", "processing"), item(5, "orphan", "complete")],
    )
    aggregated = orders.aggregate_order_items(
        items(item(1, "ok", "complete"), item(2, "refund", "complete"),
              item(3, "refund", "returned"), item(4, "odd", "processing"),
              item(5, "orphan", "complete"))
    )
    recon = orders.order_reconciliation(joined)
    assert rows(controls.unsuccessful_reconciliation(recon), "order_id") == [("orphan",)]
    assert rows(controls.unexpected_order_variance(recon, aggregated), "order_id") == [("odd",)]
    assert controls.wrong_revenue_recognition(orders.revenue(joined)).count() == 0


def test_lead_time_baseline(frame):
    schema = "shipped_at timestamp, created_at timestamp"
    late = ("2024-01-02 00:00:00", "2024-01-01 00:00:00")
    early = ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert controls.lead_time_above_baseline(frame(schema, *[late] * 17, *[early] * 3)).count() == 0
    broken = controls.lead_time_above_baseline(frame(schema, *[late] * 16, *[early] * 4)).first()
    assert broken.negative_lead_time_rate == 0.2
    assert controls.lead_time_above_baseline(frame(schema, (None, DAY))).count() == 0
