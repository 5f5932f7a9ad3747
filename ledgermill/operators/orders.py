"""Order ledgers: header against lines, revenue, refunds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import (
    distinct_list,
    guarded_ratio,
    money_sum,
    month_of,
    within_lookback,
    round_to,
)
from ledgermill.functions.calendar import AsOf
from ledgermill.operators.joins import full_outer

# The labels the audit reports show.
ORPHAN = "ERR: ORPHAN SUB-LEDGER"
MISSING = "ERR: MISSING SUB-LEDGER"
RECONCILED = "RECONCILIATION SUCCESSFUL"
MATCHED = "MATCHED"
VERIFIED = "INTEGRITY VERIFIED"
VARIANCE = "VARIANCE DETECTED"
NOT_COMPARABLE = "N/A - PREVIOUS ERROR"
PARTIAL_REFUND = "MIXED FULFILLMENT - PARTIAL REFUND"
PARTIAL_SHIPMENT = "MIXED FULFILLMENT - PARTIAL SHIPMENT"
UNEXPLAINED = "VARIANCE DETECTED - UNEXPLAINED"
PENDING = "SHIPPING_PENDING"
CUTOFF_RISK = "POTENTIAL CUT-OFF RISK"
NORMAL = "NORMAL"
NO_REFUND = "NO REFUND"
FULLY_REFUNDED = "FULLY REFUNDED"
PARTIALLY_REFUNDED = "PARTIALLY REFUNDED"
LOOKBACK_DAYS = 14


@dataclass(frozen=True)
class Lookback:
    """Window of an incremental run: rows touched in the last ``days`` days."""

    as_of: AsOf = None
    days: int = LOOKBACK_DAYS

    def touched(self, *columns: str) -> Column:
        return within_lookback([F.col(c) for c in columns], self.days, self.as_of)


def union_order_items(base: DataFrame, incremental: DataFrame) -> DataFrame:
    return base.unionByName(incremental)


def union_orders(base: DataFrame, incremental: DataFrame) -> DataFrame:
    return base.unionByName(incremental)


def aggregate_order_items(items: DataFrame) -> DataFrame:
    """Sub-ledger per order and user, combined on the map side before its one shuffle."""
    status = F.col("order_item_status")
    price = F.col("sale_price")
    returned = status == "returned"
    return items.groupBy("order_id", "user_id").agg(
        distinct_list(status).alias("order_item_status_list"),
        F.count(F.lit(1)).alias("subledger_item_count"),
        money_sum(price).alias("total_order_amount"),
        F.min("created_at").alias("first_item_created_at"),
        F.count_if(returned).alias("returned_item_count"),
        money_sum(F.when(returned, price).otherwise(0.0)).alias("refund_amount"),
        F.max("returned_at").alias("last_refund_at"),
    )


def join_master_subledger(orders: DataFrame, aggregated: DataFrame) -> DataFrame:
    """Order headers full-joined with the sub-ledger; both keys stay as presence flags."""
    lines = aggregated.select(
        F.col("order_id").alias("subledger_order_id"),
        F.col("user_id").alias("subledger_user_id"),
        F.col("order_item_status_list").alias("subledger_order_status"),
        "subledger_item_count",
        "total_order_amount",
        "first_item_created_at",
        "returned_item_count",
        "refund_amount",
        "last_refund_at",
    )
    headers = orders.select(
        F.col("order_id").alias("master_order_id"),
        F.col("user_id").alias("master_user_id"),
        F.col("order_status").alias("master_order_status"),
        F.col("number_of_items").alias("master_item_count"),
        "created_at",
        "shipped_at",
        "returned_at",
        "delivered_at",
    )
    # both sides hold about one row per order, so only rows without a key can pile up
    joined = full_outer(lines, headers, "subledger_order_id", "master_order_id")
    return joined.select(
        F.coalesce("subledger_order_id", "master_order_id").alias("order_id"),
        F.coalesce("subledger_user_id", "master_user_id").alias("user_id"),
        *[c for c in headers.columns if c != "master_user_id"],
        *[c for c in lines.columns if c != "subledger_user_id"],
    )


def touched_ledgers(
    orders: DataFrame, items: DataFrame, lookback: Lookback
) -> tuple[DataFrame, DataFrame]:
    """Headers and lines of every order an incremental run may recompute.

    An order qualifies by its first line, its last refund or its shipment, and then has a
    recent line, a recent return or a recent shipment itself. Taking all rows of those
    orders leaves the old ledger out of the shuffles of aggregation and join; the exact
    condition is applied to the result.
    """
    recent_lines = items.filter(lookback.touched("created_at", "returned_at"))
    shipped = orders.filter(lookback.touched("shipped_at"))
    order_ids = recent_lines.select("order_id").union(shipped.select("order_id")).distinct()
    return (
        orders.join(order_ids, "order_id", "left_semi"),
        items.join(order_ids, "order_id", "left_semi"),
    )


def _existence(agreed: str) -> Column:
    return (
        F.when(F.col("master_order_id").isNull(), ORPHAN)
        .when(F.col("subledger_order_id").isNull(), MISSING)
        .otherwise(agreed)
    )


def _recent_orders(joined: DataFrame, lookback: Lookback | None) -> DataFrame:
    """Orders an incremental run recomputes. A plain filter: ``order_id`` is the key."""
    if lookback is None:
        return joined
    recent = lookback.touched("first_item_created_at", "last_refund_at", "shipped_at")
    return joined.filter(F.col("order_id").isNotNull() & recent)


def order_reconciliation(joined: DataFrame, lookback: Lookback | None = None) -> DataFrame:
    """Existence, item-count and status verdicts per order."""
    comparable = F.col("master_order_id").isNotNull() & F.col("subledger_order_id").isNotNull()
    zero = F.lit(0)
    same_count = F.coalesce("master_item_count", zero) == F.coalesce("subledger_item_count", zero)
    line_statuses = F.col("subledger_order_status")
    same_status = F.col("master_order_status") == line_statuses
    returned = F.col("returned_item_count")
    partly_returned = (returned > 0) & (returned < F.col("subledger_item_count"))
    partly_shipped = (
        line_statuses.contains("shipped") & line_statuses.contains("complete") & (returned == 0)
    )

    def verdict(agrees: Column) -> Column:
        return (
            F.when(~comparable, NOT_COMPARABLE).when(agrees, VERIFIED).otherwise(VARIANCE)
        )

    return _recent_orders(joined, lookback).select(
        "order_id",
        "user_id",
        F.col("created_at").alias("order_at"),
        "total_order_amount",
        "master_item_count",
        "subledger_item_count",
        "returned_item_count",
        "master_order_status",
        "subledger_order_status",
        _existence(RECONCILED).alias("order_reconciliation"),
        verdict(same_count).alias("order_item_count_recon"),
        verdict(same_status).alias("order_status_recon"),
        F.when(~comparable, NOT_COMPARABLE)
        .when(same_status, VERIFIED)
        .when(partly_returned, PARTIAL_REFUND)
        .when(partly_shipped, PARTIAL_SHIPMENT)
        .otherwise(UNEXPLAINED)
        .alias("order_status_recon_detail"),
    )


def revenue(joined: DataFrame, lookback: Lookback | None = None) -> DataFrame:
    """Accrual revenue, recognized on shipment, with the period cut-off flag."""
    shipped = F.col("shipped_at")
    return _recent_orders(joined, lookback).select(
        "order_id",
        "user_id",
        "created_at",
        "shipped_at",
        F.col("total_order_amount").alias("gross_revenue"),
        F.coalesce("subledger_order_status", "master_order_status").alias("order_status"),
        F.when(shipped.isNull(), 0.0)
        .otherwise(F.col("total_order_amount"))
        .alias("recognized_revenue"),
        F.coalesce("subledger_item_count", "master_item_count").alias("total_item_count"),
        _existence(MATCHED).alias("data_integrity_status"),
        F.when(shipped.isNull(), PENDING)
        .when(month_of(F.col("created_at")) != month_of(shipped), CUTOFF_RISK)
        .otherwise(NORMAL)
        .alias("cutoff_status"),
    )


def refund_reconciliation(aggregated: DataFrame, lookback: Lookback | None = None) -> DataFrame:
    """Net revenue, refund rates by value and by count, and the refund type per order."""
    if lookback is not None:
        aggregated = aggregated.filter(lookback.touched("first_item_created_at", "last_refund_at"))
    gross, refund = F.col("gross_revenue"), F.col("refund_amount")
    returned, items = F.col("total_returned_items"), F.col("total_item_count")

    def rate(part: Column, whole: Column) -> Column:
        return round_to(F.coalesce(guarded_ratio(part, whole), F.lit(0.0)), 4)

    return aggregated.select(
        "order_id",
        "user_id",
        F.col("first_item_created_at").alias("order_date"),
        F.col("total_order_amount").alias("gross_revenue"),
        "refund_amount",
        F.col("subledger_item_count").alias("total_item_count"),
        F.col("returned_item_count").alias("total_returned_items"),
    ).withColumns(
        {
            "net_revenue": gross - refund,
            "refund_value_rate": rate(refund, gross),
            "refund_count_rate": rate(returned.cast("double"), items),
            "refund_type": F.when(returned == 0, NO_REFUND)
            .when(returned == items, FULLY_REFUNDED)
            .otherwise(PARTIALLY_REFUNDED),
        }
    )


def order_item_revenue(
    items: DataFrame, products: DataFrame, lookback: Lookback | None = None
) -> DataFrame:
    """Item-grain revenue with product attributes.

    No broadcast is forced on the products: below Spark's size threshold they are
    broadcast, above it the join merges and adaptive execution splits hot products.
    """
    if lookback is not None:
        items = items.filter(lookback.touched("created_at", "shipped_at", "returned_at"))
    catalog = products.select(
        "product_id",
        F.col("category").alias("product_category"),
        F.col("brand").alias("product_brand"),
        F.col("name").alias("product_name"),
    )
    return items.join(catalog, "product_id", "left_outer").select(
        "order_item_id",
        "order_id",
        "user_id",
        "product_id",
        "product_category",
        "product_brand",
        "product_name",
        "order_item_status",
        "sale_price",
        F.when(F.col("shipped_at").isNull(), 0.0)
        .otherwise(F.col("sale_price"))
        .alias("recognized_item_revenue"),
        "created_at",
        "shipped_at",
        "returned_at",
    )
