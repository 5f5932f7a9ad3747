from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgermill.operators import fiscal, inventory, joins
from ledgermill.sources import seeds
from tests.conftest import rows
from tests.test_orders import ITEMS, item

UNITS = """inventory_item_id string, product_id string, product_category string,
    product_name string, product_brand string, cost double, product_retail_price double,
    created_at timestamp, sold_at timestamp"""
HISTORY = """product_id string, retail_price double, dbt_valid_from timestamp,
    dbt_valid_to timestamp"""
AS_OF = "2024-06-30 00:00:00"


def unit(n, received, cost=10.0, price=20.0, product="p1", name="shirt"):
    return (n, product, "socks", name, "b", cost, price, received, None)


@pytest.fixture
def lifecycle(frame):
    def build(units, lines, **options):
        return inventory.inventory_lifecycle(
            frame(UNITS, *units), frame(ITEMS, *lines), AS_OF, **options
        )

    return build


def shipped_line(n, unit_id, shipped, status="complete", price=15.0, product="p1"):
    line = list(item(n, "o", status, price, shipped=shipped))
    line[3], line[4] = product, unit_id
    return tuple(line)


def test_outbound_without_inbound(lifecycle):
    lines = [shipped_line(1, "gone", AS_OF), shipped_line(2, None, AS_OF)]
    found = rows(lifecycle([], lines), "inventory_item_id", "stock_status")
    assert found == [("gone", inventory.SOLD), (None, inventory.NO_INBOUND)]
    strict = rows(lifecycle([], lines, strict=True), "inventory_item_id", "stock_status")
    assert strict == [("gone", inventory.NO_INBOUND), (None, inventory.NO_INBOUND)]


def test_statuses_that_do_not_move_stock(lifecycle):
    lines = [shipped_line(n, "u", AS_OF, status) for n, status in
             enumerate(["cancelled", "returned", "processing", None])]
    row = lifecycle([unit("u", "2024-01-01 00:00:00")], lines).collect()
    assert [(r.stock_status, r.outbound_at) for r in row] == [(inventory.ON_HAND, None)]


def test_shipped_without_a_date_stays_on_hand(lifecycle):
    row = lifecycle([unit("u", "2024-01-01 00:00:00")], [shipped_line(1, "u", None)]).first()
    assert (row.stock_status, row.sale_price) == (inventory.ON_HAND, 15.0)


def test_late_receipt_is_pulled_back(lifecycle):
    row = lifecycle(
        [unit("u", "2024-03-01 00:00:00")], [shipped_line(1, "u", "2023-12-31 12:00:00")]
    ).first()
    assert row.inbound_at == datetime(2023, 12, 31, 12)
    assert (row.days_in_inventory, row.inbound_fiscal_year) == (0, 2023)


def test_product_mismatch(lifecycle):
    row = lifecycle(
        [unit("u", "2024-01-01 00:00:00")], [shipped_line(1, "u", AS_OF, product="p2")]
    ).first()
    assert (row.product_match, row.product_id) == (inventory.PRODUCT_MISMATCH, "p1")


@pytest.mark.parametrize("sold", [False, True])
def test_age_buckets(lifecycle, sold):
    today = datetime(2024, 6, 30)
    cuts = {730: 1, 731: 2, 1095: 2, 1096: 3, 1460: 3, 1461: 4, 0: 1}
    units, lines = [], []
    for age in cuts:
        units.append(unit(f"u{age}", str(today - timedelta(days=age))))
        if sold:
            lines.append(shipped_line(age, f"u{age}", str(today)))
    labels = inventory.SOLD_AGES if sold else inventory.ON_HAND_AGES
    by_rank = {4 - i: text for i, (_, text) in enumerate(labels)}
    found = dict(rows(lifecycle(units, lines), "days_in_inventory", "aging_velocity_bucket"))
    assert found == {age: by_rank[rank] for age, rank in cuts.items()}


def test_future_receipt_has_age_zero(lifecycle):
    row = lifecycle([unit("u", "2025-01-01 00:00:00")], []).first()
    assert row.days_in_inventory == 0


def test_lower_of_cost_or_market(lifecycle):
    units = [unit("a", AS_OF, 10.0, 8.0), unit("b", AS_OF, 8.0, 10.0)]
    found = rows(
        lifecycle(units, []), "inventory_item_id", "lcm_unit_valuation", "inventory_valuation_loss"
    )
    assert found == [("a", 8.0, 2.0), ("b", 8.0, 0.0)]


def test_many_lines_may_point_at_one_unit(lifecycle):
    units = [unit("u", "2024-01-01 00:00:00"), unit("v", "2024-01-01 00:00:00")]
    lines = [shipped_line(n, "u", AS_OF) for n in range(5)]
    assert lifecycle(units, lines).groupBy("inventory_item_id").count().collect().__len__() == 2
    assert lifecycle(units, lines).count() == 6


# fiscal report


def report(spark, frame, units, lines, history=()):
    lifecycle = inventory.inventory_lifecycle(frame(UNITS, *units), frame(ITEMS, *lines), AS_OF)
    return fiscal.inventory_fiscal_report(
        lifecycle, frame(HISTORY, *history), seeds.thresholds(spark), AS_OF
    )


def test_first_year_gap_year_and_vanished_product(spark, frame):
    units = [
        unit("a", "2020-05-01 00:00:00"),
        unit("b", "2022-05-01 00:00:00", product="p2", name="hat"),
        unit("c", "2020-05-01 00:00:00", product="p3", name="cap"),
    ]
    lines = [shipped_line(1, "c", "2020-08-01 00:00:00", product="p3")]
    found = rows(
        report(spark, frame, units, lines),
        "product_id", "fiscal_year", "beginning_inv_value", "ending_gross_inv_value",
        "audit_check_diff",
    )
    assert found == [
        ("p1", 2020, 0.0, 10.0, 0.0),
        ("p1", 2022, 10.0, 10.0, 0.0),
        ("p2", 2022, 0.0, 10.0, 0.0),
        ("p3", 2020, 0.0, 0.0, 0.0),
    ]


def test_year_end_price_comes_from_the_history(spark, frame):
    units = [unit("a", "2022-05-01 00:00:00", 10.0, 20.0)]
    history = [
        ("p1", 7.0, "2022-06-01 00:00:00", "2023-06-01 00:00:00"),
        ("p1", 30.0, "2023-06-01 00:00:00", None),
    ]
    units.append(unit("b", "2023-01-01 00:00:00", 10.0, 4.0))
    found = rows(
        report(spark, frame, units, [], history),
        "fiscal_year", "ending_net_realizable_value", "ending_allowance_lcm",
        "inventory_risk_rating",
    )
    assert found == [
        (2022, 7.0, 3.0, fiscal.WRITE_DOWN),
        (2023, 20.0, 0.0, fiscal.HEALTHY),
    ]


def test_price_falls_back_to_receipt_price(spark, frame):
    units = [unit("a", "2022-05-01 00:00:00", 10.0, 4.0)]
    history = [("p1", 7.0, "2024-01-01 00:00:00", None)]
    row = report(spark, frame, units, [], history).first()
    assert row.ending_net_realizable_value == 4.0


def test_running_year_ends_today(spark, frame):
    row = report(spark, frame, [unit("a", "2024-06-20 00:00:00")], []).first()
    assert row.avg_days_on_hand_at_year_end == 10.0


def test_unknown_category_has_no_tier(spark, frame):
    units = [("a", "p1", "hats", "n", "b", 1.0, 2.0, "2024-01-01 00:00:00", None)]
    assert report(spark, frame, units, []).first().risk_tier is None


def brute_force(units, lines, history):
    """Every year against every unit, as plain Python."""
    by_unit = {line[4]: line for line in lines}
    moves = []
    for n, product, category, name, _, cost, price, received, _ in units:
        line = by_unit.get(n)
        left = datetime.fromisoformat(line[8]) if line else None
        arrived = datetime.fromisoformat(received)
        arrived = left if left and arrived > left else arrived
        moves.append((product, name, category, arrived, left, cost, price, line and line[6]))
    years = sorted({m[3].year for m in moves} | {m[4].year for m in moves if m[4]})
    out, ending_before = [], {}
    for year in years:
        end = min(date(year, 12, 31), date(2024, 6, 30))
        for product in sorted({m[0] for m in moves}):
            mine = [m for m in moves if m[0] == product]
            sold = [m for m in mine if m[4] and m[4].year == year]
            held = [m for m in mine if m[3].year <= year and not (m[4] and m[4].year <= year)]
            bought = [m for m in mine if m[3].year == year]
            at_end = datetime(end.year, end.month, end.day)
            price = next(
                (h[1] for h in history if h[0] == product
                 and datetime.fromisoformat(h[2]) <= at_end
                 and (h[3] is None or at_end < datetime.fromisoformat(h[3]))), None)
            value = round(sum(m[5] for m in held), 2)
            net = round(sum(min(m[5], m[6] if price is None else price) for m in held), 2)
            ages = [(end - m[3].date()).days for m in held]
            purchases = round(sum(m[5] for m in bought), 2)
            cogs = round(sum(m[5] for m in sold), 2)
            if purchases or cogs or held:
                out.append((
                    year, product, len(sold), cogs, round(sum(m[7] for m in sold), 2),
                    ending_before.get(product, 0.0), purchases, value, len(held), net,
                    int(sum(ages) / len(ages) * 10 + 0.5) / 10 if ages else None,
                ))
            ending_before[product] = value
    return sorted(out, key=repr)


days = st.integers(0, 1800).map(lambda n: str(datetime(2019, 6, 1) + timedelta(days=n)))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(
    st.tuples(days, st.none() | days, st.sampled_from([5.0, 5.25, 9.5]),
              st.sampled_from([4.0, 9.0]), st.sampled_from(["p1", "p2", "p3"])),
    min_size=1, max_size=25,
))
def test_report_equals_brute_force(spark, frame, drawn):
    units, lines = [], []
    for n, (received, left, cost, price, product) in enumerate(drawn):
        units.append(unit(f"u{n}", received, cost, price, product, f"name {product}"))
        if left:
            lines.append(shipped_line(n, f"u{n}", left, price=12.5, product=product))
    history = [
        ("p1", 5.1, "2020-03-01 00:00:00", "2021-12-31 00:00:00"),
        ("p1", 4.5, "2021-12-31 00:00:00", None),
        ("p2", 9.25, "2022-01-01 00:00:00", "2023-01-01 00:00:00"),
    ]
    found = rows(
        report(spark, frame, units, lines, history),
        "fiscal_year", "product_id", "period_units_sold", "period_cogs_amount", "period_revenue",
        "beginning_inv_value", "period_purchase_amount", "ending_gross_inv_value",
        "ending_inv_qty", "ending_net_realizable_value", "avg_days_on_hand_at_year_end",
    )
    assert found == brute_force(units, lines, history)


def test_stock_rolls_forward(testbed):
    """Begin + purchases - end - cost of sales is zero, and written-down value adds up."""
    broken = testbed.inventory_fiscal_report.filter(
        "audit_check_diff <> 0 or abs(ending_gross_inv_value - ending_allowance_lcm "
        "- ending_net_realizable_value) > 0.001"
    )
    assert broken.count() == 0


def test_product_year_flow_moves_cells_once(spark, frame):
    """Cells are shuffled once, to their product; prices meet them before years repeat them."""
    when = "2023-02-01 00:00:00"
    cells = frame(UNITS, unit("u1", when)).sparkSession.range(4000).selectExpr(
        "cast(id % 7 as string) product_id", "'n' product_name", "'c' product_category",
        "'b' product_brand", "2020 inbound_fiscal_year",
        "case when id % 2 = 0 then 2022 end outbound_fiscal_year", "1d historical_unit_cost",
        "2d current_market_price", "1l units", "1l identified_units", "1l sale_high",
        "0l sale_low", "19000l inbound_days",
    )
    history = frame(HISTORY, ("1", 5.0, datetime(2019, 1, 1), None))
    flow = fiscal.with_beginning_balance(fiscal.product_year_flow(cells, history, AS_OF))
    wide = [
        line
        for line in flow._jdf.queryExecution().executedPlan().toString().splitlines()
        if "Exchange hashpartitioning" in line
    ]
    assert sum("REPARTITION_BY_COL" in line for line in wide) == 1
    assert not any("fiscal_year" in line for line in wide)


def test_years_without_units_are_zero(spark, frame):
    """A product without any year has every listed one; one with a gap has the gap."""
    flow = frame(
        "fiscal_year int, product_id string, product_name string, product_category string, "
        "product_brand string, ending_gross_inv_value double, avg_days_on_hand_at_year_end double",
        (2021, "p", "n", "c", "b", 5.0, 1.0), (2024, "p", "n", "c", "b", 7.0, 2.0),
        (None, "p", "n", "c", "b", 0.0, None), (None, "q", None, "c", "b", 0.0, None),
    )
    years = spark.range(1).selectExpr("array(2020, 2021, 2022, 2024) y").scalar()
    found = {(r[1], r[0]): (r[5], r[6]) for r in fiscal.every_year(flow, years).collect()}
    empty = {(p, y): (0.0, None) for p in "pq" for y in (2020, 2021, 2022, 2024)}
    assert found == empty | {("p", 2021): (5.0, 1.0), ("p", 2024): (7.0, 2.0)}


CELL_UNITS = """product_id string, product_name string, product_category string,
    product_brand string, inbound_fiscal_year int, outbound_fiscal_year int,
    historical_unit_cost double, current_market_price double, inventory_item_id string,
    sale_price double, inbound_at timestamp"""


@pytest.mark.parametrize("least", [100_000, 3])
def test_cells_of_a_product_are_those_of_its_units(frame, monkeypatch, least):
    """Dealt by product, with and without hot ones: the cells that ``unit_cells`` counts."""
    monkeypatch.setattr(joins, "HOT_ROWS", least)
    given = [("hot", "x", "c", "b", 2020, 2021 + i % 2, 1.0, 2.0, str(i), 2.5 + i, "2020-03-01 00:00:00")
             for i in range(9)]
    given += [
        ("p", "x", "c", "b", 2020, None, 1.0, 2.0, "a", None, "2020-03-01 10:00:00"),
        ("p", "x", "c", "b", 2020, None, 1.0, 2.0, None, None, "2020-03-02 00:00:00"),
        ("p", "y", None, "b", None, None, None, 2.0, "a", 1.25, None),
        (None, "x", "c", "b", 2020, 2020, 1.0, 2.0, "b", 1.5, "2020-03-01 00:00:00"),
        (None, "x", "c", "b", 2020, 2020, 1.0, 2.0, "b", 0.75, "2020-03-01 00:00:00"),
    ]
    units = frame(CELL_UNITS, *given)
    wanted = fiscal.unit_cells(units)
    found = fiscal.product_cells(fiscal.single_cells(units))
    assert rows(found, *wanted.columns) == rows(wanted)


def test_units_of_the_report_move_once_to_their_product(frame, monkeypatch):
    """What is written is not counted before, and what is read moves by the product alone."""
    written, write = [], fiscal.staged

    def noted(df, label, *codec):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label, *codec)

    monkeypatch.setattr(fiscal, "staged", noted)
    units = frame(CELL_UNITS, ("p", "x", "c", "b", 2020, None, 1.0, 2.0, "a", None, "2020-03-01 10:00:00"))
    history = frame("product_id string, retail_price double, dbt_valid_from timestamp, dbt_valid_to timestamp")
    thresholds = frame("product_category string, risk_tier string, materiality_threshold int")
    report = fiscal.inventory_fiscal_report(units, history, thresholds, AS_OF)
    assert [plan.count("Exchange") for plan in written] == [0]
    plan = report._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(product_id" in line]
    assert any("REPARTITION_BY_COL" in line for line in moved)
    assert sum("product_name" in line.split("), ")[0] for line in moved) == 1  # of hot products and of none
