"""Business controls: each returns the rows that break it, none when it holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import guarded_ratio, round_to
from ledgermill.operators.orders import RECONCILED, VARIANCE

# Fixed value: share of shipped lines that may leave before their order date.
NEGATIVE_LEAD_BASELINE = 0.15


def unsuccessful_reconciliation(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.filter(F.col("order_reconciliation") != RECONCILED).select(
        "order_id", "order_reconciliation", "master_item_count", "subledger_item_count"
    )


def variances(reconciliation: DataFrame) -> DataFrame:
    """Orders whose item count or status differs between header and lines."""
    differs = [F.col(c) == VARIANCE for c in ("order_item_count_recon", "order_status_recon")]
    return reconciliation.filter(differs[0] | differs[1])


def unexpected_order_variance(reconciliation: DataFrame, aggregated: DataFrame) -> DataFrame:
    """Item-count variances, and status variances without a known benign cause.

    Partial refunds and partial shipments explain a status variance. Of the sub-ledger only the
    orders in ``variances`` are looked at.
    """
    lines = aggregated.select(
        "order_id",
        "order_item_status_list",
        F.col("returned_item_count").alias("returned"),
        F.col("subledger_item_count").alias("line_count"),
    )
    statuses, returned = F.col("order_item_status_list"), F.col("returned")
    partial_refund = (returned > 0) & (returned < F.col("line_count"))
    partial_shipment = (
        statuses.contains("shipped") & statuses.contains("complete") & (returned == 0)
    )
    count_variance = F.col("order_item_count_recon") == VARIANCE
    status_variance = F.col("order_status_recon") == VARIANCE
    return (
        variances(reconciliation).join(lines, "order_id", "left_outer")
        .filter(count_variance | (status_variance & ~partial_refund & ~partial_shipment))
        .select(
            "order_id",
            "master_item_count",
            "subledger_item_count",
            "order_item_count_recon",
            "order_status_recon",
        )
    )


def wrong_revenue_recognition(revenue: DataFrame) -> DataFrame:
    """Revenue recognized before shipment, or not recognized after it."""
    shipped, recognized = F.col("shipped_at").isNotNull(), F.col("recognized_revenue")
    return revenue.filter(
        (~shipped & (recognized != 0))
        | (shipped & (recognized == 0) & (F.col("gross_revenue") > 0))
    ).select("order_id", "shipped_at", "recognized_revenue", "gross_revenue")


def lead_time_above_baseline(items: DataFrame) -> DataFrame:
    """Share of shipped lines with a negative lead time, when above the baseline."""
    shipped = items.filter(F.col("shipped_at").isNotNull())
    early = F.count_if(F.col("shipped_at") < F.col("created_at"))
    rate = guarded_ratio(
        F.col("negative_lead_time_count").cast("double"), F.col("total_shipped")
    )
    return (
        shipped.agg(
            F.count(F.lit(1)).alias("total_shipped"), early.alias("negative_lead_time_count")
        )
        .withColumn("negative_lead_time_rate", round_to(rate, 4))
        .filter(F.col("negative_lead_time_rate") > NEGATIVE_LEAD_BASELINE)
    )


def run_controls(
    reconciliation: DataFrame, aggregated: DataFrame, revenue: DataFrame, items: DataFrame
) -> DataFrame:
    """Failures and status of the four controls, in the columns of the constraint results.

    Order variances and recognition are errors; the lead-time baseline is a warning.
    """
    found = [
        ("order_reconciliation", unsuccessful_reconciliation(reconciliation), "error"),
        ("order_reconciliation", unexpected_order_variance(reconciliation, aggregated), "error"),
        ("revenue", wrong_revenue_recognition(revenue), "error"),
        ("order_item_revenue", lead_time_above_baseline(items), "warn"),
    ]
    names = (
        "unsuccessful_reconciliation",
        "unexpected_order_variance",
        "wrong_revenue_recognition",
        "lead_time_above_baseline",
    )
    results = [
        broken.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("test_name"),
            F.lit(severity).alias("severity"),
            "failures",
            F.when(F.col("failures") == 0, "pass")
            .otherwise("warn" if severity == "warn" else "fail")
            .alias("status"),
        )
        for name, (table, broken, severity) in zip(names, found, strict=True)
    ]
    return reduce(DataFrame.unionByName, results)
