"""Inventory units: lifecycle, lower of cost or market, aging, sell-through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import as_of_column, days_between
from ledgermill.functions.calendar import AsOf
from ledgermill.operators.joins import full_outer_many_to_one
from ledgermill.session import staged

# Statuses that do not move stock, labels, and the year of the aging cuts.
NOT_OUTBOUND = ("cancelled", "returned", "processing")
ON_HAND = "On-hand (Ending Inventory)"
SOLD = "Sold (COGS)"
NO_INBOUND = "Error: Outbound without Inbound"
PRODUCT_MATCH = "Product Match"
PRODUCT_MISMATCH = "Product Not Match"
DAYS_PER_YEAR = 365
ON_HAND_AGES = (
    (4, "On-hand: 04. Obsolete (>4yr)"),
    (3, "On-hand: 03. Slow-moving (3yr-4yr)"),
    (2, "On-hand: 02. Stagnant (2yr-3yr)"),
    (0, "On-hand: 01. Healthy (<2y)"),
)
SOLD_AGES = (
    (4, "Sold: 04. Very Slow (>4yr)"),
    (3, "Sold: 03. Slow (3yr-4yr)"),
    (2, "Sold: 02. Normal (2yr-3yr)"),
    (0, "Sold: 01. Fast (<2y)"),
)


def union_inventory_items(base: DataFrame, incremental: DataFrame) -> DataFrame:
    return base.unionByName(incremental)


def inbound_units(inventory_items: DataFrame) -> DataFrame:
    return inventory_items.select(
        F.col("inventory_item_id").alias("inbound_item_id"),
        F.col("product_id").alias("inbound_product_id"),
        "product_category",
        "product_name",
        "product_brand",
        F.col("created_at").alias("received_at"),
        F.col("cost").alias("historical_unit_cost"),
        F.col("product_retail_price").alias("current_market_price"),
    )


def outbound_units(order_items: DataFrame) -> DataFrame:
    """Lines that take stock out. A line without a status counts as not outbound."""
    return order_items.filter(~F.col("order_item_status").isin(*NOT_OUTBOUND)).select(
        F.col("inventory_item_id").alias("outbound_item_id"),
        F.col("product_id").alias("outbound_product_id"),
        F.col("shipped_at").alias("outbound_at"),
        "sale_price",
    )


def join_units(inventory_items: DataFrame, order_items: DataFrame) -> DataFrame:
    """Inbound receipts full-joined with outbound lines, one row per unit movement.

    Receipts are unique per unit; several lines (or lines without a unit) may point at one.
    A unit cannot leave before it arrives, so a later receipt date is pulled back. The outbound
    lines are written first: the search for hot units and the join read them.
    """
    received, left = F.col("received_at"), F.col("outbound_at")
    units = full_outer_many_to_one(
        staged(outbound_units(order_items), "outbound-units", "zstd"),
        inbound_units(inventory_items),
        "outbound_item_id",
        "inbound_item_id",
    )
    return units.withColumns(
        {
            "inventory_item_id": F.coalesce("inbound_item_id", "outbound_item_id"),
            "product_id": F.coalesce("inbound_product_id", "outbound_product_id"),
            "inbound_at": F.when(received > left, left).otherwise(received),
        }
    )


def _bucket(days: Column, ages: tuple[tuple[int, str], ...]) -> Column:
    *older, (_, label) = ages
    bucket = F.lit(label)
    for years, label in reversed(older):
        bucket = F.when(days > years * DAYS_PER_YEAR, label).otherwise(bucket)
    return bucket


def unit_years(units: DataFrame) -> DataFrame:
    """Fiscal years of receipt and of shipment."""
    return units.withColumns(
        {
            "outbound_fiscal_year": F.year("outbound_at"),
            "inbound_fiscal_year": F.year("inbound_at"),
        }
    )


def inventory_lifecycle(
    inventory_items: DataFrame,
    order_items: DataFrame,
    as_of: AsOf = None,
    strict: bool = False,
) -> DataFrame:
    """Unit-level sub-ledger with carrying value, age and stock status.

    ``strict`` flags units that left without a receipt; by default only rows without any
    unit id are flagged, as the reports expect.
    """
    cost, market = F.col("historical_unit_cost"), F.col("current_market_price")
    arrived, left = F.col("inbound_at"), F.col("outbound_at")
    today = as_of_column(as_of).cast("date")
    days = F.col("days_in_inventory")
    flagged_id = F.col("inbound_item_id" if strict else "inventory_item_id")
    units = unit_years(join_units(inventory_items, order_items))
    return (
        units.withColumns(
            {
                "lcm_unit_valuation": F.least(cost, market),
                "days_in_inventory": F.when(
                    arrived.isNotNull(),
                    F.when(left.isNotNull(), days_between(arrived, left)).otherwise(
                        F.greatest(days_between(arrived, today), F.lit(0))
                    ),
                ),
            }
        )
        .withColumns(
            {
                "inventory_valuation_loss": cost - F.col("lcm_unit_valuation"),
                "aging_velocity_bucket": F.when(
                    left.isNull(), _bucket(days, ON_HAND_AGES)
                ).otherwise(_bucket(days, SOLD_AGES)),
                "stock_status": F.when(flagged_id.isNull(), NO_INBOUND)
                .when(left.isNull(), ON_HAND)
                .otherwise(SOLD),
                "product_match": F.when(
                    F.col("inbound_product_id") != F.col("outbound_product_id"), PRODUCT_MISMATCH
                ).otherwise(PRODUCT_MATCH),
            }
        )
        .select(
            "inventory_item_id",
            "product_id",
            "product_category",
            "product_name",
            "product_brand",
            "inbound_at",
            "outbound_at",
            "historical_unit_cost",
            "current_market_price",
            "sale_price",
            "lcm_unit_valuation",
            "inventory_valuation_loss",
            "days_in_inventory",
            "aging_velocity_bucket",
            "stock_status",
            "product_match",
            "outbound_fiscal_year",
            "inbound_fiscal_year",
        )
    )


def inventory_sellthrough(inventory_items: DataFrame) -> DataFrame:
    """One row per unit ever received, with whether it ever sold."""
    return inventory_items.select(
        "inventory_item_id",
        "product_id",
        "product_category",
        "product_brand",
        "product_name",
        "cost",
        "product_retail_price",
        "created_at",
        "sold_at",
        F.col("sold_at").isNull().alias("is_unsold"),
        F.year("created_at").alias("received_fiscal_year"),
    )
