"""Schemas of the raw tables. Identifiers are read as written and cast in staging."""

from __future__ import annotations

ORDERS = """
    order_id long, user_id long, status string, gender string, created_at timestamp,
    returned_at timestamp, shipped_at timestamp, delivered_at timestamp, num_of_item long
"""

ORDER_ITEMS = """
    id long, order_id long, user_id long, product_id long, inventory_item_id long,
    status string, created_at timestamp, shipped_at timestamp, delivered_at timestamp,
    returned_at timestamp, sale_price double
"""

PRODUCTS = """
    id long, cost double, category string, name string, brand string, retail_price double,
    department string, sku string, distribution_center_id long
"""

USERS = """
    id long, first_name string, last_name string, email string, age long, gender string,
    state string, street_address string, postal_code string, city string, country string,
    latitude double, longitude double, traffic_source string, created_at timestamp,
    user_geom string
"""

INVENTORY_ITEMS = """
    id long, product_id long, created_at timestamp, sold_at timestamp, cost double,
    product_category string, product_name string, product_brand string,
    product_retail_price double, product_department string, product_sku string,
    product_distribution_center_id long
"""

THRESHOLDS = (
    "product_category string, risk_tier string, materiality_threshold int, rationale string"
)

PRICE_HISTORY = """
    product_id string, cost double, retail_price double, category string, brand string,
    product_name string, dbt_valid_from timestamp, dbt_valid_to timestamp
"""

# Extracted tables (written once) and growing tables (appended to daily).
BASE_TABLES = {
    "raw_orders": ORDERS,
    "raw_order_items": ORDER_ITEMS,
    "raw_products": PRODUCTS,
    "raw_users": USERS,
    "raw_inventory_items": INVENTORY_ITEMS,
}
GROWING_TABLES = {
    "incr_orders": ORDERS,
    "incr_order_items": ORDER_ITEMS,
    "incr_inventory_items": INVENTORY_ITEMS,
}
RAW_TABLES = BASE_TABLES | GROWING_TABLES
