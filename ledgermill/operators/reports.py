"""Audit exception reports: typed exceptions in order of severity.

Each order ends with the key of the row. Severity and amount alone leave large groups of
equal rows, which a range-partitioned sort would have to put into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import days_between, month_of
from ledgermill.operators import fiscal
from ledgermill.operators.orders import (
    CUTOFF_RISK,
    FULLY_REFUNDED,
    MATCHED,
    MISSING,
    NO_REFUND,
    NORMAL,
    ORPHAN,
    PARTIALLY_REFUNDED,
    PENDING,
    RECONCILED,
    VARIANCE,
)
from ledgermill.session import staged

# Exception labels and limits.
IMBALANCE = "INVENTORY EQUATION IMBALANCE"
WRITE_DOWN_REQUIRED = "LCM WRITE-DOWN REQUIRED"
OBSOLETE_STOCK = "OBSOLETE STOCK"
SLOW_STOCK = "SLOW-MOVING STOCK"
FULL_REFUND_HIGH_VALUE = "FULL REFUND - HIGH VALUE ORDER"
PARTIAL_REFUND_OVER_HALF = "PARTIAL REFUND - EXCEEDS 50% OF ORDER VALUE"
PARTIAL_REFUND_MIXED = "PARTIAL REFUND - MIXED STATUS ORDER"
HIGH_VALUE = 100
OVER_HALF = 0.5
NEGATIVE_LEAD = "NEGATIVE LEAD TIME - IMPOSSIBLE SEQUENCE"
EXCESSIVE_LEAD = "EXCESSIVE LEAD TIME - OVER 7 DAYS"
MAX_LEAD_DAYS = 7


def by_severity(column: str, *labels: str) -> Column:
    """Rank of a label in the given order; any other label comes last."""
    rank = F.lit(len(labels) + 1)
    for position, label in reversed(list(enumerate(labels, 1))):
        rank = F.when(F.col(column) == label, position).otherwise(rank)
    return rank


def inventory_exceptions(report: DataFrame) -> DataFrame:
    """Flagged product years. They are written before the sort, which reads its input twice."""
    rating = F.col("inventory_risk_rating")
    difference = F.col("audit_check_diff")
    flagged = (
        report.filter((difference != 0) | (rating != fiscal.HEALTHY))
        .select(
            "fiscal_year",
            "product_id",
            "product_name",
            "product_category",
            "product_brand",
            "audit_check_diff",
            "ending_gross_inv_value",
            "ending_net_realizable_value",
            "ending_allowance_lcm",
            "inventory_risk_rating",
            "avg_days_on_hand_at_year_end",
            "inventory_turnover_ratio",
            "gross_profit_margin",
            F.when(difference != 0, IMBALANCE)
            .when(rating == fiscal.OBSOLETE, OBSOLETE_STOCK)
            .when(rating == fiscal.SLOW_MOVING, SLOW_STOCK)
            .when(rating == fiscal.WRITE_DOWN, WRITE_DOWN_REQUIRED)
            .alias("exception_type"),
        )
    )
    return staged(flagged, "inventory-exceptions").orderBy(
        by_severity("exception_type", IMBALANCE, WRITE_DOWN_REQUIRED, OBSOLETE_STOCK, SLOW_STOCK),
        F.abs(difference).desc_nulls_last(),
        "product_id",
        "fiscal_year",
        "product_name",
    )


def order_reconciliation_failures(reconciliation: DataFrame) -> DataFrame:
    return (
        reconciliation.filter(
            (F.col("order_reconciliation") != RECONCILED)
            | (F.col("order_item_count_recon") == VARIANCE)
            | (F.col("order_status_recon") == VARIANCE)
        )
        .select(
            "order_id",
            "user_id",
            "order_at",
            "total_order_amount",
            "master_item_count",
            "subledger_item_count",
            (F.col("master_item_count") - F.col("subledger_item_count")).alias(
                "item_count_variance"
            ),
            F.col("order_reconciliation").alias("existence_check"),
            F.col("order_item_count_recon").alias("item_count_check"),
            F.col("order_status_recon").alias("status_check"),
        )
        .orderBy(
            by_severity("existence_check", ORPHAN, MISSING),
            F.abs("item_count_variance").desc_nulls_last(),
            F.col("total_order_amount").desc_nulls_last(),
            "order_id",
        )
    )


def revenue_cutoff_risk(revenue: DataFrame) -> DataFrame:
    gross, recognized = F.col("gross_revenue"), F.col("recognized_revenue")
    return (
        revenue.filter(
            (F.col("cutoff_status") != NORMAL) | (F.col("data_integrity_status") != MATCHED)
        )
        .select(
            "order_id",
            "user_id",
            "order_status",
            "created_at",
            "shipped_at",
            "gross_revenue",
            "recognized_revenue",
            (gross - recognized).alias("unrecognized_amount"),
            "data_integrity_status",
            "cutoff_status",
            month_of(F.col("created_at")).alias("order_month"),
            month_of(F.col("shipped_at")).alias("ship_month"),
        )
        .orderBy(
            by_severity("cutoff_status", CUTOFF_RISK, PENDING),
            gross.desc_nulls_last(),
            "order_id",
        )
    )


def refund_anomalies(refunds: DataFrame) -> DataFrame:
    """Partial refunds, and full refunds of large orders.

    Every partial refund counts as a mixed-status order, so the label for refunds above
    half of the value never applies; it is kept for its place in the severity order.
    """
    kind = F.col("refund_type")
    partial = kind == PARTIALLY_REFUNDED
    flag = (
        F.when(partial, PARTIAL_REFUND_MIXED)
        .when((kind == FULLY_REFUNDED) & (F.col("gross_revenue") >= HIGH_VALUE),
              FULL_REFUND_HIGH_VALUE)
        .when(partial & (F.col("refund_value_rate") > OVER_HALF), PARTIAL_REFUND_OVER_HALF)
    )
    return (
        refunds.filter(kind != NO_REFUND)
        .select(
            "order_id",
            "user_id",
            "order_date",
            "gross_revenue",
            "refund_amount",
            "net_revenue",
            "total_item_count",
            "total_returned_items",
            "refund_value_rate",
            "refund_count_rate",
            "refund_type",
            flag.alias("anomaly_flag"),
        )
        .filter(F.col("anomaly_flag").isNotNull())
        .orderBy(
            by_severity(
                "anomaly_flag",
                FULL_REFUND_HIGH_VALUE,
                PARTIAL_REFUND_OVER_HALF,
                PARTIAL_REFUND_MIXED,
            ),
            F.col("gross_revenue").desc_nulls_last(),
            "order_id",
        )
    )


def fulfillment_lead_time_anomalies(items: DataFrame) -> DataFrame:
    """Lines shipped before their order or long after it, the worst first.

    The flagged rows, a large part of all lines, are written before they are sorted: a sort by
    range reads its input twice, and would derive them twice.
    """
    ordered, shipped = F.col("created_at"), F.col("shipped_at")
    lead = F.col("lead_time_days")
    flagged = (
        items.filter(shipped.isNotNull())
        .select(
            "order_item_id",
            "order_id",
            "user_id",
            "product_id",
            "order_item_status",
            "sale_price",
            "created_at",
            "shipped_at",
            days_between(ordered, shipped).alias("lead_time_days"),
        )
        .withColumn(
            "anomaly_flag",
            F.when(shipped < ordered, NEGATIVE_LEAD).when(lead > MAX_LEAD_DAYS, EXCESSIVE_LEAD),
        )
        .filter(F.col("anomaly_flag").isNotNull())
    )
    return staged(flagged, "lead-time-anomalies").orderBy(
        by_severity("anomaly_flag", NEGATIVE_LEAD), F.abs(lead).desc_nulls_last(), "order_item_id"
    )
