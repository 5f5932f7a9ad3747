"""The finance semantic models and their 26 metrics.

Fixed values: names and definitions are the ones users query by.
"""

from __future__ import annotations

from pyspark.sql import Column

from ledgermill.functions import guarded_ratio
from ledgermill.metrics.model import (
    Cumulative,
    Derived,
    Input,
    Measure,
    Metric,
    Ratio,
    SemanticModel,
    Simple,
)

HIGH_VALUE_ORDER = 200

REVENUE = SemanticModel(
    name="revenue",
    primary="order",
    entities={"order": "order_id", "user": "user_id"},
    dimensions={
        "order_status": "order_status",
        "data_integrity_status": "data_integrity_status",
        "cutoff_status": "cutoff_status",
        "is_high_value_order": f"coalesce(gross_revenue > {HIGH_VALUE_ORDER}, false)",
    },
    time_dimensions={"created_at": "created_at", "shipped_at": "shipped_at"},
    metric_time="created_at",
    measures=(
        Measure("recognized_revenue", "sum", "recognized_revenue"),
        Measure("gross_revenue", "sum", "gross_revenue"),
        Measure("order_count", "count_distinct", "order_id"),
        Measure("total_item_count", "sum", "total_item_count"),
    ),
)

REFUNDS = SemanticModel(
    name="refund_reconciliation",
    primary="order",
    entities={"order": "order_id", "user": "user_id"},
    dimensions={"refund_type": "refund_type"},
    time_dimensions={"order_date": "order_date"},
    metric_time="order_date",
    measures=(
        Measure("refund_gross_revenue", "sum", "gross_revenue"),
        Measure("refund_amount", "sum", "refund_amount"),
        Measure("net_revenue", "sum", "net_revenue"),
        Measure("total_returned_items", "sum", "total_returned_items"),
        # Counts every order of the ledger, refunded or not; no metric uses it.
        Measure("refunded_order_count", "count_distinct", "order_id"),
    ),
)

INVENTORY = SemanticModel(
    name="inventory_fiscal_report",
    primary="product",
    entities={"product": "product_id", "product_category": "product_category"},
    dimensions={
        "fiscal_year": "cast(fiscal_year as string)",
        "product_name": "product_name",
        "product_brand": "product_brand",
        "inventory_risk_rating": "inventory_risk_rating",
    },
    time_dimensions={"fiscal_year_end_date": "least(make_date(fiscal_year, 12, 31), {today})"},
    metric_time="fiscal_year_end_date",
    finest_grain="year",
    unique_key=False,
    measures=(
        Measure("period_revenue", "sum", "period_revenue"),
        Measure("period_cogs", "sum", "period_cogs_amount"),
        Measure("period_units_sold", "sum", "period_units_sold"),
        Measure("ending_inventory_value", "sum", "ending_gross_inv_value"),
        Measure("ending_nrv", "sum", "ending_net_realizable_value"),
        Measure("lcm_allowance", "sum", "ending_allowance_lcm"),
    ),
)

ORDER_ITEMS = SemanticModel(
    name="order_item_revenue",
    primary="order_item",
    entities={
        "order_item": "order_item_id",
        "order": "order_id",
        "user": "user_id",
        "product": "product_id",
    },
    dimensions={"order_item_status": "order_item_status"},
    time_dimensions={"created_at": "created_at", "shipped_at": "shipped_at"},
    metric_time="created_at",
    measures=(
        Measure("item_gross_revenue", "sum", "sale_price"),
        Measure("recognized_item_revenue", "sum", "recognized_item_revenue"),
        Measure("item_count", "count_distinct", "order_item_id"),
    ),
)

MATERIALITY = SemanticModel(
    name="audit_materiality",
    primary="product_category",
    entities={"product_category": "product_category"},
    dimensions={
        "risk_tier": "risk_tier",
        "materiality_threshold": "materiality_threshold",
        "rationale": "rationale",
    },
)

MODELS: tuple[SemanticModel, ...] = (REVENUE, REFUNDS, INVENTORY, ORDER_ITEMS, MATERIALITY)


def growth_percent(now: Column, before: Column) -> Column:
    """Growth over an earlier value; NULL when that was zero or missing."""
    return guarded_ratio((now - before) * 100, before)


def difference(left: Column, right: Column) -> Column:
    return left - right


def _growth(name: str, metric: str) -> Derived:
    return Derived(name, growth_percent, (Input(metric), Input(metric, offset_months=1)))


METRICS: tuple[Metric, ...] = (
    Simple("total_recognized_revenue", "recognized_revenue"),
    Simple("total_gross_revenue", "gross_revenue"),
    Simple("order_count", "order_count"),
    Ratio("revenue_recognition_rate", "total_recognized_revenue", "total_gross_revenue"),
    Simple("total_refund_amount", "refund_amount"),
    Simple("total_net_revenue", "net_revenue"),
    Simple("refund_base_gross_revenue", "refund_gross_revenue"),
    Ratio("refund_rate", "total_refund_amount", "refund_base_gross_revenue"),
    Simple("total_item_gross_revenue", "item_gross_revenue"),
    Simple("total_recognized_item_revenue", "recognized_item_revenue"),
    Simple("item_count", "item_count"),
    Ratio("item_recognition_rate", "total_recognized_item_revenue", "total_item_gross_revenue"),
    Cumulative("cumulative_recognized_revenue", "recognized_revenue"),
    Cumulative("cumulative_gross_revenue", "gross_revenue"),
    Cumulative("cumulative_refund_amount", "refund_amount"),
    Cumulative("cumulative_order_count", "order_count"),
    _growth("revenue_growth_mom", "total_recognized_revenue"),
    _growth("gross_revenue_growth_mom", "total_gross_revenue"),
    Derived(
        "refund_rate_change_mom",
        difference,
        (Input("refund_rate"), Input("refund_rate", offset_months=1)),
    ),
    _growth("item_revenue_growth_mom", "total_recognized_item_revenue"),
    Simple("total_inventory_value", "ending_inventory_value"),
    Simple("total_net_realizable_value", "ending_nrv"),
    Simple("total_lcm_allowance", "lcm_allowance"),
    Simple("total_cogs", "period_cogs"),
    Simple("total_period_revenue", "period_revenue"),
    Derived(
        "inventory_gross_profit",
        difference,
        (Input("total_period_revenue"), Input("total_cogs")),
    ),
)

# Balances: a sum over several fiscal years of these counts the same stock repeatedly.
YEAR_END_BALANCES = ("total_inventory_value", "total_net_realizable_value", "total_lcm_allowance")
