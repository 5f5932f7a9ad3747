from __future__ import annotations

import warnings
from datetime import date

import pytest

from ledgermill.metrics import MetricStore
from ledgermill.metrics.finance import METRICS, MODELS
from tests.conftest import rows

REVENUE = """order_id string, user_id string, created_at timestamp, shipped_at timestamp,
    gross_revenue double, order_status string, recognized_revenue double, total_item_count long,
    data_integrity_status string, cutoff_status string"""
REFUNDS = """order_id string, user_id string, order_date timestamp, gross_revenue double,
    refund_amount double, total_item_count long, total_returned_items long, net_revenue double,
    refund_value_rate double, refund_count_rate double, refund_type string"""
REPORT = """fiscal_year int, product_id string, product_name string, product_category string,
    product_brand string, period_units_sold long, period_cogs_amount double,
    period_revenue double, ending_gross_inv_value double, ending_allowance_lcm double,
    ending_net_realizable_value double, inventory_risk_rating string"""
TIERS = "product_category string, risk_tier string, materiality_threshold int, rationale string"


def order(n, at, amount, status="complete", shipped=True, user="u"):
    recognized = amount if shipped else 0.0
    return (n, user, at, at if shipped else None, amount, status, recognized, 1, "MATCHED",
            "NORMAL")


def refund(n, at, gross, back):
    kind = "NO REFUND" if back == 0 else "FULLY REFUNDED"
    return (n, "u", at, gross, back, 1, int(back > 0), gross - back, back / gross, 0.0, kind)


@pytest.fixture
def store(frame):
    def build(revenue=(), refunds=(), report=(), tiers=()):
        return MetricStore(
            {
                "revenue": frame(REVENUE, *revenue),
                "refund_reconciliation": frame(REFUNDS, *refunds),
                "inventory_fiscal_report": frame(REPORT, *report),
                "audit_materiality": frame(TIERS, *tiers),
            },
            as_of="2024-06-30 00:00:00",
        )

    return build


JAN, FEB, APR = "2024-01-15 10:00:00", "2024-02-15 00:00:00", "2024-04-15 00:00:00"


def test_all_models_and_metrics_are_declared():
    assert len(METRICS) == 26 and len({m.name for m in METRICS}) == 26
    assert len(MODELS) == 5 and sum(len(m.measures) for m in MODELS) == 18


def test_simple_and_ratio(store):
    s = store([order("1", JAN, 0.1), order("2", JAN, 0.2, shipped=False), order("3", FEB, 5.0)])
    found = rows(s.query(
        ["total_gross_revenue", "order_count", "revenue_recognition_rate"], ["metric_time__month"]
    ))
    assert found == [(date(2024, 1, 1), 0.3, 2, 0.1 / 0.3), (date(2024, 2, 1), 5.0, 1, 1.0)]


def test_ratio_without_a_base_is_null(store):
    assert rows(store([order("1", JAN, 0.0)]).query(["revenue_recognition_rate"])) == [(None,)]


def test_cumulative_repeats_through_an_empty_month(store):
    s = store([order("1", JAN, 1.0), order("2", FEB, 2.0), order("3", APR, 4.0),
               order("4", None, 100.0)])
    found = rows(s.query(["cumulative_gross_revenue", "cumulative_order_count"],
                         ["metric_time__month"]))
    assert found == [
        (date(2024, 1, 1), 1.0, 1), (date(2024, 2, 1), 3.0, 2),
        (date(2024, 3, 1), 3.0, 2), (date(2024, 4, 1), 7.0, 3),
    ]
    assert rows(s.query(["cumulative_gross_revenue"])) == [(7.0,)]


def test_cumulative_groups_start_at_their_first_period(store):
    s = store([order("1", JAN, 1.0, "a"), order("2", FEB, 2.0, "b")])
    found = rows(s.query(["cumulative_gross_revenue"],
                         ["order__order_status", "metric_time__month"]))
    assert found == [
        ("a", date(2024, 1, 1), 1.0), ("a", date(2024, 2, 1), 1.0), ("b", date(2024, 2, 1), 2.0),
    ]


def test_year_to_date_restarts(store):
    s = store([order("1", "2023-12-01 00:00:00", 50.0), order("2", JAN, 1.0),
               order("3", FEB, 2.0)])
    found = rows(s.query(["cumulative_gross_revenue"], ["metric_time__month"],
                         "metric_time__day >= '2024-01-01'"))
    assert found == [(date(2024, 1, 1), 1.0), (date(2024, 2, 1), 3.0)]


def test_cumulative_follows_the_given_spine(spark, store):
    """Periods come from the spine that is joined; several measures share one aggregation."""
    s = store([order("1", JAN, 1.0), order("2", FEB, 2.0), order("3", APR, 4.0)])
    s.spine = spark.sql("select explode(array(date'2024-01-20', date'2024-03-05', date'2024-07-01')) as date_day")
    metrics = ["cumulative_gross_revenue", "cumulative_recognized_revenue", "cumulative_order_count"]
    found = s.query(metrics, ["metric_time__month"])
    assert rows(found) == [(date(2024, 1, 1), 1.0, 1.0, 1), (date(2024, 3, 1), 3.0, 3.0, 2)]
    whole = store([order("1", JAN, 1.0)]).query(metrics[:2], ["metric_time__day"])
    assert rows(whole) == [(date(2024, 1, 15), 1.0, 1.0)]
    assert store([]).query(metrics, ["metric_time__day"]).count() == 0


def test_cumulative_sums_share_an_aggregation(store, monkeypatch):
    """All sums of a model are aggregated once, however many metrics ask for them."""
    from ledgermill.metrics import query

    plans = []

    def noted(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return staged(df, label)

    staged = query.staged
    monkeypatch.setattr(query, "staged", noted)
    s = store([order("1", JAN, 1.0)])
    s.query(["cumulative_gross_revenue", "cumulative_recognized_revenue"], ["metric_time__day"])
    assert len(plans) == 1 and plans[0].count("Aggregate [") == 1


def test_growth_is_null_without_the_month_before(store):
    s = store([order("1", JAN, 2.0), order("2", FEB, 3.0), order("3", APR, 4.0)])
    found = dict(rows(s.query(["gross_revenue_growth_mom"], ["metric_time__month"])))
    assert found == {
        date(2024, 1, 1): None, date(2024, 2, 1): 50.0, date(2024, 3, 1): None,
        date(2024, 4, 1): None, date(2024, 5, 1): None,
    }


def test_growth_over_zero_is_null(store):
    s = store([order("1", JAN, 0.0), order("2", FEB, 3.0)])
    found = dict(rows(s.query(["gross_revenue_growth_mom"], ["metric_time__month"])))
    assert found[date(2024, 2, 1)] is None


def test_growth_sees_the_month_before_the_filter(store):
    s = store([order("1", JAN, 2.0), order("2", FEB, 3.0)])
    found = rows(s.query(["gross_revenue_growth_mom"], ["metric_time__month"],
                         ["metric_time__month >= '2024-02-01'",
                          "metric_time__month < '2024-03-01'"]))
    assert found == [(date(2024, 2, 1), 50.0)]


def test_growth_under_a_mixed_condition(store):
    """Time and a dimension in one string; a value that looks like a column; OR across both."""
    s = store([order("1", JAN, 2.0, "a__b"), order("2", FEB, 3.0, "a__b"), order("3", FEB, 9.0, "x"),
               order("4", APR, 5.0, "x")])
    found = rows(s.query(["gross_revenue_growth_mom"], ["metric_time__month"],
                         "metric_time__month between '2024-02-01' and '2024-02-29' "
                         "and order__order_status = 'a__b'"))
    assert found == [(date(2024, 2, 1), 50.0)]
    status = "order__order_status in ('x', 'metric_time__day')"
    assert rows(s.query(["order_count"], where=[status])) == [(2,)]
    either = f"metric_time__month = '2024-02-01' or {status}"
    found = dict(rows(s.query(["gross_revenue_growth_mom"], ["metric_time__month"], either)))
    # February from all its rows against January's seen from February; then status x alone
    assert found == {date(2024, 2, 1): 500.0, date(2024, 3, 1): None, date(2024, 4, 1): None,
                     date(2024, 5, 1): None}


def test_a_condition_within_a_month_moves_with_the_offset(store):
    s = store([order("1", "2024-01-05 00:00:00", 100.0), order("2", "2024-01-20 00:00:00", 2.0),
               order("3", "2024-02-05 00:00:00", 100.0), order("4", "2024-02-20 00:00:00", 3.0)])
    found = rows(s.query(["gross_revenue_growth_mom"], ["metric_time__month"],
                         "metric_time__day >= '2024-02-10' and metric_time__month <= '2024-02-01'"))
    assert found == [(date(2024, 2, 1), 50.0)]


def test_daily_growth_looks_back_one_calendar_month(store):
    s = store([order("1", "2023-02-28 00:00:00", 2.0), order("2", "2023-03-28 00:00:00", 3.0),
               order("3", "2023-03-31 00:00:00", 4.0)])
    found = dict(rows(s.query(["gross_revenue_growth_mom"], ["metric_time__day"])))
    assert found[date(2023, 3, 28)] == 50.0 and found[date(2023, 3, 31)] == 100.0
    assert set(found) == {
        date(2023, 2, 28), *(date(2023, 3, d) for d in (28, 29, 30, 31)),
        date(2023, 4, 28),
    }


def test_refund_rate_change_is_a_metric_of_metrics(store):
    s = store(refunds=[refund("1", JAN, 10.0, 0.0), refund("2", FEB, 10.0, 10.0),
                       refund("3", FEB, 30.0, 0.0)])
    found = dict(rows(s.query(["refund_rate_change_mom"], ["metric_time__month"])))
    assert found[date(2024, 2, 1)] == 0.25


def test_models_meet_only_after_aggregation(store):
    s = store(
        [order("1", JAN, 10.0), order("2", JAN, 20.0), order("3", None, 5.0)],
        [refund("1", JAN, 10.0, 10.0), refund("9", FEB, 40.0, 0.0)],
    )
    found = rows(s.query(["total_gross_revenue", "total_refund_amount"], ["metric_time__month"]))
    assert found == [
        (None, 5.0, None), (date(2024, 1, 1), 30.0, 10.0), (date(2024, 2, 1), None, 0.0),
    ]


def report_row(year, product, cogs, revenue, category="socks"):
    return (year, product, "n", category, "b", 1, cogs, revenue, 10.0, 1.0, 9.0, "Healthy")


def test_inventory_by_risk_tier(store):
    s = store(
        report=[report_row(2023, "p", 4.0, 9.0), report_row(2024, "p", 1.0, 2.0),
                report_row(2024, "q", 7.0, 8.0, "hats")],
        tiers=[("socks", "Low", 2500, "why")],
    )
    found = rows(s.query(["inventory_gross_profit"],
                         ["product_category__risk_tier", "product__fiscal_year"]))
    assert found == [("Low", "2023", 5.0), ("Low", "2024", 1.0), (None, "2024", 1.0)]
    yearly = rows(s.query(["total_cogs"], ["metric_time__year"]))
    assert yearly == [(date(2023, 1, 1), 4.0), (date(2024, 1, 1), 8.0)]


def test_balances_without_a_year_warn(store):
    s = store(report=[report_row(2023, "p", 4.0, 9.0)])
    with pytest.warns(UserWarning, match="year-end balances"):
        s.query(["total_inventory_value"], ["product__product_category"])
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        s.query(["total_inventory_value"], ["product__fiscal_year"])


def test_unreachable_or_too_fine_groups_are_refused(store):
    s = store()
    with pytest.raises(ValueError, match="cannot be reached"):
        s.query(["total_gross_revenue"], ["product__product_brand"])
    with pytest.raises(ValueError, match="no grain finer"):
        s.query(["total_cogs"], ["metric_time__month"])
    with pytest.raises(ValueError, match="need metric_time"):
        s.query(["revenue_growth_mom"], ["order__order_status"])


@pytest.mark.parametrize("metric", [m.name for m in METRICS])
def test_every_metric_answers(testbed, metric):
    from ledgermill.catalog.metrics import store as testbed_store

    model = "year" if "inventory" in metric or metric in (
        "total_net_realizable_value", "total_lcm_allowance", "total_cogs", "total_period_revenue"
    ) else "month"
    df = testbed_store(testbed).query([metric], [f"metric_time__{model}"])
    assert df.columns == [f"metric_time__{model}", metric]
    assert df.filter(f"{metric} is not null").count() > 0
