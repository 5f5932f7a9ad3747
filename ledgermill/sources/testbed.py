"""Adapter from the star-schema test tables to the raw ledger tables.

The ledgers are derived from the whole tables: line items become order items and inventory
units, orders become headers, parts become products, customers become users. Known defects
are planted by attribute so that every reconciliation branch occurs:

* headers of status P and priority 5-LOW were never posted (orphan sub-ledgers);
* headers of status O and priority 1-URGENT claim one item too many (count variance);
* inventory cost moves around the list price with the discount (both valuation branches);
* only products up to size 25 have a price history (both price sources).
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ledgermill.operators import inventory, orders
from ledgermill.operators.fiscal import inventory_fiscal_report
from ledgermill.schemas import RAW_TABLES
from ledgermill.session import configure, staged
from ledgermill.sources import seeds
from ledgermill.sources.staging import stage

AS_OF = "2001-08-01 00:00:00"
SPLIT_DATE = "2001-01-01 00:00:00"
FIRST_PRICES_FROM = "1995-06-01 00:00:00"
SECOND_PRICES_FROM = "1998-07-01 00:00:00"

# Product type to product category.
CATEGORIES = {
    "ECONOMY": "Socks",
    "PROMO": "Swim",
    "STANDARD": "Jeans",
    "MEDIUM": "Dresses",
    "SMALL": "Suits",
    "LARGE": "Outerwear & Coats",
}


def _days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


# Schemas of the test tables that are read, so that no footer is opened to infer them.
TEST_TABLES = {
    "orders": """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "part": """p_partkey long, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "customer": """c_custkey long, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


class Testbed:
    """Raw, staged, intermediate and mart frames over one folder of test tables."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(TEST_TABLES[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    def keep(self, *names: str) -> None:
        """Write these frames once, in the order given, so that all that derive from them read
        files and do not repeat their joins."""
        for name in names:
            self.__dict__[name] = staged(getattr(self, name), name.replace("_", "-"), "zstd")

    # raw tables

    @cached_property
    def line_table(self) -> DataFrame:
        return with_line_status(self.table("lineitem"))

    def with_headers(self, lines: DataFrame) -> DataFrame:
        headers = self.table("orders").select(
            "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("ordered_at")
        )
        return lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def headed_lines(self) -> DataFrame:
        """All line items with their headers: what order and inventory items derive from."""
        return self.with_headers(self.table("lineitem")).drop("l_tax", "o_orderkey")

    def order_items_of(self, line_items: DataFrame) -> DataFrame:
        """Order items of all or some test line items."""
        return self._order_items(self.with_headers(line_items))

    def _order_items(self, headed: DataFrame) -> DataFrame:
        """The texts of a line are derived after its join, so that numbers are shuffled."""
        return with_line_status(headed).select(
            F.col("line_id").alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("line_id").alias("inventory_item_id"),
            "status",
            F.col("l_extendedprice").alias("sale_price"),
            F.col("ordered_at").alias("created_at"),
            "shipped_at",
            (F.col("shipped_at") + _days(3)).alias("delivered_at"),
            "returned_at",
        )

    @cached_property
    def all_order_items(self) -> DataFrame:
        return self._order_items(self.headed_lines)

    @cached_property
    def all_orders(self) -> DataFrame:
        per_order = self.line_table.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("line_count"),
            F.min("shipped_at").alias("shipped_at"),
            F.max("returned_at").alias("returned_at"),
        )
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        never_posted = (status == "P") & (priority == "5-LOW")
        one_too_many = (status == "O") & (priority == "1-URGENT")
        return (
            self.table("orders")
            .filter(~never_posted)
            .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left_outer")
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("user_id"),
                F.when(status == "F", "Complete")
                .when(status == "O", "Shipped")
                .otherwise("Processing")
                .alias("status"),
                F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
                F.col("o_orderdate").cast("timestamp").alias("created_at"),
                "returned_at",
                "shipped_at",
                (F.col("shipped_at") + _days(3)).alias("delivered_at"),
                (
                    F.coalesce("line_count", F.lit(0)) + F.when(one_too_many, 1).otherwise(0)
                ).alias("num_of_item"),
            )
        )

    @cached_property
    def all_inventory_items(self) -> DataFrame:
        discount_steps = F.round(F.col("l_discount") * 100, 0).cast("int")
        list_price = F.col("retail_price").cast("decimal(10,2)")
        return (
            with_line_status(
                self.headed_lines.join(self.raw_products.alias("p"), F.col("l_partkey") == F.col("p.id"))
            )
            .select(
                F.col("line_id").alias("id"),
                F.col("l_partkey").alias("product_id"),
                (F.col("ordered_at") - _days(45)).alias("created_at"),
                F.when(F.col("status") == "Complete", F.col("shipped_at")).alias("sold_at"),
                (list_price + discount_steps * 20 - 150).cast("double").alias("cost"),
                F.col("category").alias("product_category"),
                F.col("name").alias("product_name"),
                F.col("brand").alias("product_brand"),
                F.col("retail_price").alias("product_retail_price"),
                F.col("department").alias("product_department"),
                F.col("sku").alias("product_sku"),
                F.col("distribution_center_id").alias("product_distribution_center_id"),
                F.col("ordered_at"),
            )
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        kind = F.col("p_type")
        category = reduce(
            lambda col, pair: col.when(kind == pair[0], pair[1]),
            list(CATEGORIES.items())[1:],
            F.when(kind == "ECONOMY", CATEGORIES["ECONOMY"]),
        )
        price = F.col("p_retailprice")
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            (price.cast("decimal(10,2)") - 150).cast("double").alias("cost"),
            category.alias("category"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            price.alias("retail_price"),
            F.when(F.col("p_partkey") % 2 == 0, "Women").otherwise("Men").alias("department"),
            F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
            F.col("p_size").alias("distribution_center_id"),
        )

    @cached_property
    def raw_users(self) -> DataFrame:
        unknown = F.lit(None).cast("string")
        nations = self.table("nation").select("n_nationkey", "n_name")
        return (
            self.table("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_outer")
            .select(
                F.col("c_custkey").alias("id"),
                F.col("c_name").alias("first_name"),
                unknown.alias("last_name"),
                F.concat("c_name", F.lit("@example.com")).alias("email"),
                F.lit(None).cast("long").alias("age"),
                F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
                unknown.alias("state"),
                unknown.alias("street_address"),
                unknown.alias("postal_code"),
                unknown.alias("city"),
                F.col("n_name").alias("country"),
                F.lit(None).cast("double").alias("latitude"),
                F.lit(None).cast("double").alias("longitude"),
                F.lit("Search").alias("traffic_source"),
                F.lit("1995-01-01 00:00:00").cast("timestamp").alias("created_at"),
                unknown.alias("user_geom"),
            )
        )

    @cached_property
    def price_history(self) -> DataFrame:
        first, second = (
            F.lit(text).cast("timestamp") for text in (FIRST_PRICES_FROM, SECOND_PRICES_FROM)
        )
        old_price = (F.col("retail_price").cast("decimal(10,2)") - 100).cast("double")
        versions = F.array(
            F.struct(
                old_price.alias("retail_price"),
                first.alias("dbt_valid_from"),
                second.alias("dbt_valid_to"),
            ),
            F.struct(
                F.col("retail_price"),
                second.alias("dbt_valid_from"),
                F.lit(None).cast("timestamp").alias("dbt_valid_to"),
            ),
        )
        return (
            self.raw_products.filter(F.col("distribution_center_id") <= 25)
            .withColumn("version", F.explode(versions))
            .select(
                F.col("id").cast("string").alias("product_id"),
                "cost",
                "version.retail_price",
                F.lower("category").alias("category"),
                F.lower("brand").alias("brand"),
                F.col("name").alias("product_name"),
                "version.dbt_valid_from",
                "version.dbt_valid_to",
            )
        )

    def raw(self, name: str) -> DataFrame:
        """A raw table; orders before the split date are extracted, later ones incremental."""
        if name in ("raw_products", "raw_users"):
            return getattr(self, name)
        source, table = name.split("_", 1)
        ordered_at = F.col("ordered_at" if table == "inventory_items" else "created_at")
        split = F.lit(SPLIT_DATE).cast("timestamp")
        part = ordered_at < split if source == "raw" else ordered_at >= split
        return getattr(self, f"all_{table}").filter(part).drop("ordered_at")

    def extracted(self, name: str) -> DataFrame:
        """A raw table as its extract declares it: text ids become numbers."""
        raw = self.raw(name)
        columns = [
            (number_of(f.name) if raw.schema[f.name].dataType != f.dataType
             and raw.schema[f.name].dataType == StringType()
             else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in StructType.fromDDL(RAW_TABLES[name]).fields
        ]
        return raw.select(columns)

    # staging, intermediate and marts

    def staged(self, name: str) -> DataFrame:
        return stage(name, self.raw(name))

    def both(self, table: str) -> DataFrame:
        return self.staged(f"raw_{table}").unionByName(self.staged(f"incr_{table}"))

    @cached_property
    def thresholds(self) -> DataFrame:
        return seeds.thresholds(self.spark)

    @cached_property
    def products(self) -> DataFrame:
        return self.staged("raw_products")

    @cached_property
    def users(self) -> DataFrame:
        return self.staged("raw_users")

    @cached_property
    def orders(self) -> DataFrame:
        return orders.union_orders(self.staged("raw_orders"), self.staged("incr_orders"))

    @cached_property
    def order_items(self) -> DataFrame:
        return orders.union_order_items(
            self.staged("raw_order_items"), self.staged("incr_order_items")
        )

    @cached_property
    def inventory_items(self) -> DataFrame:
        return inventory.union_inventory_items(
            self.staged("raw_inventory_items"), self.staged("incr_inventory_items")
        )

    @cached_property
    def aggregated(self) -> DataFrame:
        return orders.aggregate_order_items(self.order_items)

    @cached_property
    def joined(self) -> DataFrame:
        return orders.join_master_subledger(self.orders, self.aggregated)

    @cached_property
    def lifecycle(self) -> DataFrame:
        return inventory.inventory_lifecycle(self.inventory_items, self.order_items, AS_OF)

    @cached_property
    def order_reconciliation(self) -> DataFrame:
        return orders.order_reconciliation(self.joined)

    @cached_property
    def revenue(self) -> DataFrame:
        return orders.revenue(self.joined)

    @cached_property
    def refund_reconciliation(self) -> DataFrame:
        return orders.refund_reconciliation(self.aggregated)

    @cached_property
    def order_item_revenue(self) -> DataFrame:
        return orders.order_item_revenue(self.order_items, self.products)

    @cached_property
    def inventory_sellthrough(self) -> DataFrame:
        return inventory.inventory_sellthrough(self.inventory_items)

    @cached_property
    def inventory_fiscal_report(self) -> DataFrame:
        return inventory_fiscal_report(
            self.lifecycle, self.price_history, self.thresholds, AS_OF
        )


def number_of(text: str) -> Column:
    """A number for a text id: the first 15 digits of its digest."""
    digits = F.substring(F.md5(F.col(text).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def with_line_status(lines: DataFrame) -> DataFrame:
    """Line id, status, shipment and return times of the test line items."""
    returned = F.col("l_returnflag") == "R"
    status, ship_at = F.col("status"), F.col("l_shipdate").cast("timestamp")
    unshipped = (status == "Cancelled") | (
        (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")
    )
    key = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    key += [F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string")]
    return lines.withColumns(
        {
            "line_id": F.concat_ws("-", *key),
            "status": F.when(returned, "Returned")
            .when(F.col("l_quantity") == 1, "Cancelled")
            .when(F.col("l_linestatus") == "F", "Complete")
            .when(F.col("l_returnflag") == "A", "Shipped")
            .otherwise("Processing"),
        }
    ).withColumns(
        {
            "shipped_at": F.when(unshipped, None).otherwise(ship_at),
            "returned_at": F.when(returned, ship_at + _days(7)),
        }
    )
