"""Dashboard feeds: small aggregates of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import exact_sum, guarded_ratio, money_sum, month_of, round_to
from ledgermill.operators.orders import (
    CUTOFF_RISK,
    PARTIAL_REFUND,
    PARTIAL_SHIPMENT,
    RECONCILED,
    UNEXPLAINED,
    VARIANCE,
)


def monthly_revenue(revenue: DataFrame) -> DataFrame:
    """Gross against recognized revenue and cut-off risk per order month."""
    return revenue.groupBy(month_of(F.col("created_at")).alias("order_month")).agg(
        money_sum(F.col("gross_revenue")).alias("gross_revenue"),
        money_sum(F.col("recognized_revenue")).alias("recognized_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(F.col("cutoff_status") == CUTOFF_RISK).alias("cutoff_risk_orders"),
    )


def reconciliation_status(reconciliation: DataFrame) -> DataFrame:
    """Orders per verdict, split into genuine failures and benign variances."""
    detail = F.col("order_status_recon_detail")
    genuine = (
        (F.col("order_reconciliation") != RECONCILED)
        | (F.col("order_item_count_recon") == VARIANCE)
        | (detail == UNEXPLAINED)
    )
    kind = (
        F.when(genuine, "genuine")
        .when(detail.isin(PARTIAL_REFUND, PARTIAL_SHIPMENT), "benign")
        .otherwise("clean")
    )
    return reconciliation.groupBy(
        "order_reconciliation",
        "order_item_count_recon",
        "order_status_recon_detail",
        kind.alias("variance_kind"),
    ).agg(F.count(F.lit(1)).alias("order_count"))


def refund_rate_trend(refunds: DataFrame) -> DataFrame:
    return (
        refunds.groupBy(month_of(F.col("order_date")).alias("order_month"))
        .agg(
            money_sum(F.col("gross_revenue")).alias("gross_revenue"),
            money_sum(F.col("refund_amount")).alias("refund_amount"),
        )
        .withColumn(
            "refund_rate",
            round_to(guarded_ratio(F.col("refund_amount"), F.col("gross_revenue")), 4),
        )
    )


def return_rate_by_category(items: DataFrame) -> DataFrame:
    return (
        items.groupBy("product_category")
        .agg(
            F.count(F.lit(1)).alias("item_count"),
            F.count_if(F.col("order_item_status") == "returned").alias("returned_count"),
        )
        .withColumn(
            "return_rate",
            round_to(
                guarded_ratio(F.col("returned_count").cast("double"), F.col("item_count")), 4
            ),
        )
    )


def lead_time_integrity(items: DataFrame) -> DataFrame:
    """Shipped lines by whether they left before their order date."""
    early = F.col("shipped_at") < F.col("created_at")
    return (
        items.filter(F.col("shipped_at").isNotNull())
        .groupBy(F.when(early, "negative").otherwise("valid").alias("lead_time"))
        .agg(F.count(F.lit(1)).alias("item_count"))
    )


def inventory_controls(report: DataFrame) -> DataFrame:
    """Write-downs, materiality breaches and age of stock per fiscal year."""
    breach = F.abs("audit_check_diff") > F.col("materiality_threshold")
    quantity, age = F.col("ending_inv_qty"), F.col("avg_days_on_hand_at_year_end")
    weighted_age = exact_sum(age, F.when(age.isNotNull(), quantity))
    return report.groupBy("fiscal_year").agg(
        money_sum(F.col("ending_gross_inv_value")).alias("ending_gross_inv_value"),
        money_sum(F.col("ending_allowance_lcm")).alias("lcm_write_down"),
        F.count_if(breach).alias("materiality_breaches"),
        round_to(
            guarded_ratio(
                weighted_age.cast("double"), F.sum(F.when(age.isNotNull(), quantity))
            ),
            1,
        ).alias("avg_days_on_hand"),
    )


def unsold_share(sellthrough: DataFrame) -> DataFrame:
    """Share of units received per fiscal year that never sold."""
    return (
        sellthrough.groupBy("received_fiscal_year")
        .agg(
            F.count(F.lit(1)).alias("units_received"),
            F.count_if("is_unsold").alias("units_unsold"),
        )
        .withColumn(
            "unsold_share",
            round_to(
                guarded_ratio(F.col("units_unsold").cast("double"), F.col("units_received")), 4
            ),
        )
    )
