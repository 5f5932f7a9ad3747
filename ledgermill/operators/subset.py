"""A referentially intact subset around a sample of products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_key(key: Column, seed: str) -> Column:
    """Order of a repeatable random draw."""
    return F.md5(F.concat(key.cast("string"), F.lit(seed)))


def sample_products(order_items: DataFrame, n: int, seed: str) -> DataFrame:
    """``n`` distinct products at random, the same on every run for one seed."""
    products = order_items.select("product_id").distinct()
    return products.orderBy(sample_key(F.col("product_id"), seed), "product_id").limit(n)


def snowball_subset(tables: dict[str, DataFrame], n: int, seed: str = "0") -> dict[str, DataFrame]:
    """Sampled products, their orders, and everything those orders refer to.

    Takes and returns the five extracted tables. Keys travel through semi joins, never
    through the driver.
    """
    items = tables["raw_order_items"]
    products = sample_products(items, n, seed)
    order_ids = items.join(products, "product_id", "left_semi").select("order_id").distinct()
    orders = tables["raw_orders"].join(order_ids, "order_id", "left_semi")
    kept_items = items.join(orders.select("order_id"), "order_id", "left_semi")
    product_ids = kept_items.select("product_id").distinct()
    user_ids = orders.select(F.col("user_id").alias("id")).distinct()
    return {
        "raw_orders": orders,
        "raw_order_items": kept_items,
        "raw_inventory_items": tables["raw_inventory_items"].join(
            product_ids, "product_id", "left_semi"
        ),
        "raw_users": tables["raw_users"].join(user_ids, "id", "left_semi"),
        "raw_products": tables["raw_products"].join(
            product_ids.withColumnRenamed("product_id", "id"), "id", "left_semi"
        ),
    }
