"""Merges, look-back windows, price history, freshness and the daily stream."""

from datetime import datetime

from pyspark.sql import functions as F

from ledgermill.catalog.prelude import AS_OF as SQL_AS_OF
from ledgermill.catalog.prelude import MODELS
from ledgermill.catalog.registry import query
from ledgermill.operators import orders
from ledgermill.operators.freshness import freshness
from ledgermill.operators.merge import (
    merge_mart,
    month_period,
    read_mart,
    rebuild_mart,
    sync_columns,
    upsert,
)
from ledgermill.operators.orders import Lookback
from ledgermill.operators.scd2 import as_of_lookup, snapshot_prices
from ledgermill.plans import daily
from ledgermill.session import stage_path
from ledgermill.sources import tables
from ledgermill.sources.staging import price_snapshot_input, stage_order_items
from ledgermill.sources.testbed import (
    AS_OF,
    FIRST_PRICES_FROM,
    SECOND_PRICES_FROM,
    TEST_TABLES,
)
from ledgermill.streaming.upsert import file_stream, stream_orders, stream_upsert

RUN_DAYS = (AS_OF, "2001-08-05 00:00:00")  # a Wednesday and the Sunday after it
THIRD_PRICES_FROM = "2000-01-01 00:00:00"
RECENT = (
    f"order_date >= {SQL_AS_OF} - interval 14 day "
    f"or order_id in (select order_id from aggregated "
    f"where last_refund_at >= {SQL_AS_OF} - interval 14 day)"
)


def base_refunds(t):
    """The refund mart as it was before the incremental tables arrived."""
    return orders.refund_reconciliation(
        orders.aggregate_order_items(t.staged("raw_order_items"))
    )


def recent_refunds(t):
    return orders.refund_reconciliation(t.aggregated, Lookback(AS_OF))


MERGED_REFUNDS = f"""
    , updates as (select * from refund_reconciliation where {RECENT})
    select * from updates union all
    select * from base_refunds where order_id not in (select order_id from updates)"""


@query("i01_upsert", MERGED_REFUNDS)
def _(t):
    return upsert(base_refunds(t), recent_refunds(t), "order_id")


@query("i01_merge_mart", MERGED_REFUNDS)
def _(t):
    path = stage_path(t.spark, "mart-refunds")
    rebuild_mart(base_refunds(t), path, month_period("order_date"))
    merge_mart(t.spark, path, recent_refunds(t), "order_id", month_period("order_date"))
    return read_mart(t.spark, path, t.refund_reconciliation.schema)


RECENT_ORDERS = f"""
    , recent as (select * from joined where order_id is not null
        and greatest(first_item_created_at, last_refund_at, shipped_at)
            >= {SQL_AS_OF} - interval 14 day)
    """


@query(
    "i02_recent_revenue", RECENT_ORDERS + MODELS["revenue"].replace("from joined", "from recent")
)
def _(t):
    return orders.revenue(t.joined, Lookback(AS_OF))


@query(
    "i02_recent_reconciliation",
    RECENT_ORDERS + MODELS["order_reconciliation"].replace("from joined", "from recent"),
)
def _(t):
    return orders.order_reconciliation(t.joined, Lookback(AS_OF))


@query(
    "i02_recent_item_revenue",
    f"select * from order_item_revenue "
    f"where greatest(created_at, shipped_at, returned_at) >= {SQL_AS_OF} - interval 14 day",
)
def _(t):
    path, times = stage_path(t.spark, "items"), ("created_at", "shipped_at", "returned_at")
    tables.append_parquet(t.order_items, path, cluster_by=times)
    lines = t.spark.read.schema(t.order_items.schema).parquet(path)
    return orders.order_item_revenue(lines, t.products, Lookback(AS_OF))


@query(
    "i03_refresh_switch",
    MERGED_REFUNDS.replace("select * from updates", "select 'merged' as run, * from updates")
    .replace("select * from base_refunds", "select 'merged', * from base_refunds")
    + " union all select 'rebuilt', * from refund_reconciliation",
)
def _(t):
    root, wednesday, sunday = stage_path(t.spark, "runs"), *map(datetime.fromisoformat, RUN_DAYS)
    name = "refund_reconciliation"
    daily.refresh_mart(t.spark, root, name, base_refunds(t), None)
    days = []
    for run, day in (("merged", wednesday), ("rebuilt", sunday)):
        lookback = daily.lookback_for(day)
        rows = orders.refund_reconciliation(t.aggregated, lookback)
        mart = daily.refresh_mart(t.spark, root, name, rows, lookback)
        days.append(mart.select(F.lit(run).alias("run"), "*"))
    return days[0].unionByName(days[1])


@query("i03_full_refresh", "select * from refund_reconciliation")
def _(t):
    path = stage_path(t.spark, "mart-refunds")
    rebuild_mart(base_refunds(t), path, month_period("order_date"))
    rebuild_mart(t.refund_reconciliation, path, month_period("order_date"))
    return read_mart(t.spark, path, t.refund_reconciliation.schema)


@query(
    "i04_schema_sync",
    "select order_id, user_id, order_date, gross_revenue, refund_amount, total_item_count, "
    "total_returned_items, net_revenue, refund_value_rate, refund_count_rate, "
    "cast(null as varchar) as refund_type from base_refunds",
)
def _(t):
    old = base_refunds(t).drop("refund_type").withColumn("legacy_flag", F.lit(True))
    return sync_columns(old, t.refund_reconciliation.schema)


def _catalog_versions(t):
    """Product catalog on three days: old prices, no swimwear, swimwear back and rebranded."""
    tracked = F.col("distribution_center_id") <= 25
    old_price = (F.col("retail_price").cast("decimal(10,2)") - 100).cast("double")
    products = t.raw_products
    first = products.withColumn(
        "retail_price", F.when(tracked, old_price).otherwise(F.col("retail_price"))
    )
    second = products.filter(F.col("category") != "Swim")
    third = products.withColumn("brand", F.concat("brand", F.lit(" II")))
    days = (FIRST_PRICES_FROM, SECOND_PRICES_FROM, THIRD_PRICES_FROM)
    return zip(days, map(price_snapshot_input, (first, second, third)), strict=True)


@query(
    "d12_price_history",
    f"""
    , base as (
        select cast(id as varchar) as product_id, cost, retail_price,
            lower(category) as category, lower(brand) as brand, name as product_name,
            distribution_center_id <= 25 as repriced, category = 'Swim' as swim,
            cast(cast(retail_price as decimal(10,2)) - 100 as double) as old_price
        from raw_products)
    select product_id, cost, if(repriced, old_price, retail_price) as retail_price, category,
        brand, product_name, timestamp '{FIRST_PRICES_FROM}' as dbt_valid_from,
        if(repriced or swim, timestamp '{SECOND_PRICES_FROM}', null) as dbt_valid_to
    from base
    union all
    select product_id, cost, retail_price, category, brand, product_name,
        timestamp '{SECOND_PRICES_FROM}', null from base where repriced and not swim
    union all
    select product_id, cost, retail_price, category, brand || ' ii', product_name,
        timestamp '{THIRD_PRICES_FROM}', null from base where swim""",
)
def _(t):
    history = None
    for day, catalog in _catalog_versions(t):
        history = snapshot_prices(history, catalog, day)
    return history


@query(
    "i05_price_change",
    f"""
    select cast(id as varchar) as product_id, cost,
        cast(cast(retail_price as decimal(10,2)) - v.cut as double) as retail_price,
        lower(category) as category, lower(brand) as brand, name as product_name,
        v.valid_from as dbt_valid_from, v.valid_to as dbt_valid_to
    from raw_products, (values
        (100, timestamp '{FIRST_PRICES_FROM}', timestamp '{SECOND_PRICES_FROM}'),
        (0, timestamp '{SECOND_PRICES_FROM}', null)) v(cut, valid_from, valid_to)""",
)
def _(t):
    old_price = (F.col("retail_price").cast("decimal(10,2)") - 100).cast("double")
    current = price_snapshot_input(t.raw_products)
    before = price_snapshot_input(t.raw_products.withColumn("retail_price", old_price))
    history = snapshot_prices(None, before, FIRST_PRICES_FROM)
    history = snapshot_prices(history, current, SECOND_PRICES_FROM)
    return snapshot_prices(history, current, THIRD_PRICES_FROM)


@query(
    "i06_hard_deletes",
    f"select product_id, category, timestamp '{FIRST_PRICES_FROM}' as dbt_valid_from, "
    f"if(category = 'swim', timestamp '{SECOND_PRICES_FROM}', null) as dbt_valid_to from products",
)
def _(t):
    everything = price_snapshot_input(t.raw_products)
    remaining = everything.filter(F.col("category") != "swim")
    history = snapshot_prices(None, everything, FIRST_PRICES_FROM)
    return snapshot_prices(history, remaining, SECOND_PRICES_FROM).select(
        "product_id", "category", "dbt_valid_from", "dbt_valid_to"
    )


@query(
    "i07_point_in_time_price",
    "select inventory_item_id, i.product_id, h.retail_price, "
    "coalesce(h.retail_price, product_retail_price) as price_used from inventory_items i "
    "left join price_history h on h.product_id = i.product_id and sold_at >= dbt_valid_from "
    "and (dbt_valid_to is null or sold_at < dbt_valid_to)",
)
def _(t):
    units = t.inventory_items.select(
        "inventory_item_id", "product_id", "product_retail_price", "sold_at"
    )
    history = t.price_history.select("product_id", "retail_price", "dbt_valid_from", "dbt_valid_to")
    return as_of_lookup(units, history, "product_id", F.col("sold_at")).select(
        "inventory_item_id",
        "product_id",
        "retail_price",
        F.coalesce("retail_price", "product_retail_price").alias("price_used"),
    )


def _freshness_sql(table: str, as_of: str) -> str:
    return (
        f"select '{table}' as source, max_loaded_at, age_hours, "
        f"case when age_hours <= 30 then 'pass' when age_hours <= 54 then 'warn' "
        f"else 'error' end as status from (select max(created_at) as max_loaded_at, "
        f"datediff('second', max(created_at), {as_of}) / 3600.0 as age_hours from {table})"
    )


@query(
    "i08_freshness",
    _freshness_sql("incr_orders", f"({SQL_AS_OF} + interval 31 hour)")
    + " union all "
    + _freshness_sql("incr_order_items", f"({SQL_AS_OF} + interval 31 hour)")
    + " union all "
    + _freshness_sql("raw_orders", f"({SQL_AS_OF} + interval 31 hour)"),
)
def _(t):
    later = F.lit("2001-08-02 07:00:00").cast("timestamp")
    results = [
        freshness(t.raw(name), as_of=later).select(F.lit(name).alias("source"), "*")
        for name in ("incr_orders", "incr_order_items", "raw_orders")
    ]
    return results[0].unionByName(results[1]).unionByName(results[2])


@query("i09_stream_upsert", "select * from order_item_revenue")
def _(t):
    spark, mart = t.spark, stage_path(t.spark, "mart-items")
    lines = file_stream(spark, t.sf_dir, TEST_TABLES["lineitem"], "lineitem.parquet")
    stream = stream_upsert(
        lines,
        lambda batch: orders.order_item_revenue(
            stage_order_items(t.order_items_of(batch)), t.products
        ),
        mart,
        "order_item_id",
        stage_path(spark, "stream"),
        month_period("created_at"),
    )
    stream.awaitTermination()
    return read_mart(spark, mart, t.order_item_revenue.schema)


@query("i09_stateful_orders", "select * from refund_reconciliation where order_id is not null")
def _(t):
    """Returned lines arrive after all others; the stream is started anew in between."""
    spark, mart = t.spark, stage_path(t.spark, "mart-refunds")
    folder, checkpoint = stage_path(spark, "lines"), stage_path(spark, "stream")
    late = F.col("order_item_status") == "returned"
    for arriving in (t.order_items.filter(~late), t.order_items.filter(late)):
        tables.append_parquet(arriving, folder)
        lines = file_stream(spark, folder, t.order_items.schema)
        stream_orders(
            lines,
            orders.refund_reconciliation,
            mart,
            "order_id",
            checkpoint,
            month_period("order_date"),
        ).awaitTermination()
    return read_mart(spark, mart, t.refund_reconciliation.schema)
