"""Staging: rename, cast and lower-case raw tables. Catalyst folds these into the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(*names: str) -> list[Column]:
    return [F.col(n).cast("string").alias(n) for n in names]


def _lower(*names: str) -> list[Column]:
    return [F.lower(n).alias(n) for n in names]


def _number(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def _time(*names: str) -> list[Column]:
    return [F.col(n).cast("timestamp").alias(n) for n in names]


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_text("order_id", "user_id"),
        F.lower("status").alias("order_status"),
        F.lower("gender").alias("user_gender"),
        F.col("num_of_item").alias("number_of_items"),
        *_time("created_at", "returned_at", "shipped_at", "delivered_at"),
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").cast("string").alias("order_item_id"),
        *_text("order_id", "user_id", "product_id", "inventory_item_id"),
        F.lower("status").alias("order_item_status"),
        *_number("sale_price"),
        *_time("created_at", "shipped_at", "delivered_at", "returned_at"),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").cast("string").alias("product_id"),
        *_text("distribution_center_id"),
        *_lower("category"),
        "name",
        "brand",
        "department",
        "sku",
        *_number("cost", "retail_price"),
    )


def stage_users(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").cast("string").alias("user_id"),
        *_lower("first_name", "last_name", "email", "gender", "state", "street_address"),
        "postal_code",
        *_lower("city", "country", "traffic_source"),
        "age",
        "latitude",
        "longitude",
        *_time("created_at"),
        "user_geom",
    )


def stage_inventory_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").cast("string").alias("inventory_item_id"),
        *_text("product_id"),
        "product_distribution_center_id",
        *_lower("product_category"),
        "product_name",
        "product_brand",
        *_lower("product_department"),
        "product_sku",
        *_number("cost", "product_retail_price"),
        *_time("created_at", "sold_at"),
    )


STAGING = {
    "raw_orders": stage_orders,
    "raw_order_items": stage_order_items,
    "raw_products": stage_products,
    "raw_users": stage_users,
    "raw_inventory_items": stage_inventory_items,
    "incr_orders": stage_orders,
    "incr_order_items": stage_order_items,
    "incr_inventory_items": stage_inventory_items,
}


def stage(name: str, raw: DataFrame) -> DataFrame:
    return STAGING[name](raw)


def price_snapshot_input(raw_products: DataFrame) -> DataFrame:
    """The product columns whose history the price snapshot keeps."""
    return raw_products.select(
        F.col("id").cast("string").alias("product_id"),
        *_number("cost", "retail_price"),
        *_lower("category", "brand"),
        F.col("name").alias("product_name"),
    )
