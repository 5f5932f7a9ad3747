"""Sources, sinks and staging."""

from pyspark.sql import functions as F

from ledgermill.catalog.prelude import AS_OF as SQL_AS_OF
from ledgermill.catalog.registry import query
from ledgermill.operators.inventory import inbound_units, outbound_units
from ledgermill.operators.subset import snowball_subset
from ledgermill.schemas import BASE_TABLES, GROWING_TABLES, RAW_TABLES
from ledgermill.session import stage_path, staged
from ledgermill.sources import tables
from ledgermill.sources.spine import time_spine
from ledgermill.sources.testbed import AS_OF

STAGED = {
    "p01_stage_orders": ("raw_orders", "stg_raw_orders"),
    "p02_stage_order_items": ("raw_order_items", "stg_raw_order_items"),
    "p03_stage_products": ("raw_products", "products"),
    "p04_stage_users": ("raw_users", "users"),
    "p05_stage_inventory_items": ("raw_inventory_items", "stg_raw_inventory_items"),
    "p06_stage_incremental_order_items": ("incr_order_items", "stg_incr_order_items"),
    "p07_stage_incremental_orders": ("incr_orders", "stg_incr_orders"),
    "p08_stage_incremental_inventory_items": ("incr_inventory_items", "stg_incr_inventory_items"),
}

for _name, (_table, _model) in STAGED.items():
    query(_name, f"select * from {_model}")(lambda t, table=_table: t.staged(table))


@query("s01_parquet_scan", "select * from raw_orders")
def _(t):
    root = stage_path(t.spark, "ledger")
    tables.write_parquet(t.raw("raw_orders"), f"{root}/raw_orders.parquet")
    return tables.load(t.spark, root, "raw_orders")


def _extract_sql(name: str) -> str:
    """All rows of a raw table under its declared types; text ids as in the adapter."""
    text_ids = {"raw_order_items": ("id", "inventory_item_id"), "raw_inventory_items": ("id",)}
    numbered = text_ids.get(name.replace("incr_", "raw_"), ())
    columns = []
    for field in RAW_TABLES[name].split(","):
        column, kind = field.split()
        if column in numbered:
            value = f"cast('0x' || substr(md5({column}), 1, 15) as bigint)"
        elif kind == "long":
            value = f"cast({column} as bigint)"
        else:
            value = column
        columns.append(f"{value} as {column}")
    return f"select {', '.join(columns)} from {name}"


def _written_once(name: str):
    def build(t):
        root = stage_path(t.spark, "ledger")
        tables.write_parquet(t.extracted(name), f"{root}/{name}.parquet")
        return tables.load(t.spark, root, name)

    return build


def _appended_daily(name: str):
    """The growing table after two batches, the second laid out for look-backs.

    The rows are written once: both batches and the sample for the layout read them.
    """

    def build(t):
        root, rows = stage_path(t.spark, "ledger"), staged(t.extracted(name), "extract")
        first = F.col("created_at") < F.lit("2001-04-01 00:00:00").cast("timestamp")
        times = [c for c in ("created_at", "shipped_at", "returned_at") if c in rows.columns]
        path = f"{root}/{name}.parquet"
        tables.append_parquet(rows.filter(first), path)
        tables.append_parquet(rows.filter(~first), path, cluster_by=tuple(times))
        return tables.load(t.spark, root, name)

    return build


for _name in BASE_TABLES:
    query(f"s01_scan_{_name}", _extract_sql(_name))(_written_once(_name))
for _name in GROWING_TABLES:
    query(f"s02_scan_{_name}", _extract_sql(_name))(_appended_daily(_name))


@query(
    "s02_incremental_scan",
    "select 'incr_orders' as source, count(*) as row_count, "
    "min(created_at) as first_order, max(created_at) as last_order from incr_orders "
    "union all select 'incr_inventory_items', 0, null, null",
)
def _(t):
    root = stage_path(t.spark, "ledger")
    tables.append_parquet(t.raw("incr_orders"), f"{root}/incr_orders.parquet")
    return _summaries(
        {n: tables.load(t.spark, root, n) for n in ("incr_orders", "incr_inventory_items")}
    )


def _summaries(frames):
    rows = [
        df.agg(
            F.lit(name).alias("source"),
            F.count(F.lit(1)).alias("row_count"),
            F.min("created_at").alias("first_order"),
            F.max("created_at").alias("last_order"),
        )
        for name, df in frames.items()
    ]
    return rows[0].unionByName(rows[1])


@query(
    "s03_seed_coverage",
    "select t.product_category, risk_tier, materiality_threshold, rationale, "
    "count(product_id) as products from thresholds t "
    "left join products p on p.category = t.product_category group by all",
)
def _(t):
    counted = t.products.groupBy("category").agg(F.count("product_id").alias("found"))
    return t.thresholds.join(
        counted, F.col("product_category") == F.col("category"), "left_outer"
    ).select(
        "product_category",
        "risk_tier",
        "materiality_threshold",
        "rationale",
        F.coalesce("found", F.lit(0)).alias("products"),
    )


@query("s04_parquet_sink", "select * from products")
def _(t):
    path = stage_path(t.spark, "products")
    tables.write_parquet(t.products.filter("product_id is null"), path)
    tables.write_parquet(t.products, path)
    tables.write_parquet(t.products, path)
    return t.spark.read.schema(t.products.schema).parquet(path)


@query("s05_daily_append", "select * from ledger_orders")
def _(t):
    path = stage_path(t.spark, "orders")
    tables.append_parquet(t.staged("raw_orders"), path)
    tables.append_parquet(t.staged("incr_orders"), path)
    return t.spark.read.schema(t.orders.schema).parquet(path)


@query("s06_csv_export", "select * from refund_reconciliation")
def _(t):
    out = stage_path(t.spark, "export")
    tables.export_csv({"refund_reconciliation": t.refund_reconciliation}, out)
    reader = t.spark.read.schema(t.refund_reconciliation.schema).option("header", True)
    return reader.option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(
        f"{out}/refund_reconciliation"
    )


@query("s07_materialize_view", "select * from order_item_revenue")
def _(t):
    tables.materialize(t.order_items, "ledger_order_items", "view")
    tables.materialize(t.products, "ledger_products", "view")
    return t.spark.sql(
        "select order_item_id, order_id, user_id, i.product_id, category as product_category, "
        "brand as product_brand, name as product_name, order_item_status, sale_price, "
        "if(shipped_at is null, 0, sale_price) as recognized_item_revenue, "
        "created_at, shipped_at, returned_at from ledger_order_items i "
        "left join ledger_products p on i.product_id = p.product_id"
    )


@query("s07_materialize_table", "select * from inventory_sellthrough")
def _(t):
    path = stage_path(t.spark, "sellthrough")
    return tables.materialize(t.inventory_sellthrough, "mart_sellthrough", "table", path)


SUBSET_SIZE = 20


@query(
    "s08_snowball_subset",
    f"""
    , picked as (
        select product_id from (select distinct product_id from raw_order_items)
        order by md5(cast(product_id as varchar) || '7'), product_id limit {SUBSET_SIZE}),
    kept_orders as (
        select * from raw_orders where order_id in (
            select order_id from raw_order_items where product_id in (from picked))),
    kept_items as (
        select * from raw_order_items where order_id in (select order_id from kept_orders))
    select 'raw_orders' as table_name, cast(order_id as varchar) as id from kept_orders
    union all select 'raw_order_items', id from kept_items
    union all select 'raw_inventory_items', id from raw_inventory_items
        where product_id in (select product_id from kept_items)
    union all select 'raw_users', cast(id as varchar) from raw_users
        where id in (select user_id from kept_orders)
    union all select 'raw_products', cast(id as varchar) from raw_products
        where id in (select product_id from kept_items)""",
)
def _(t):
    names = ("orders", "order_items", "inventory_items", "users", "products")
    subset = snowball_subset({f"raw_{n}": t.raw(f"raw_{n}") for n in names}, SUBSET_SIZE, "7")
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            F.col("order_id" if name == "raw_orders" else "id").cast("string").alias("id"),
        )
        for name, df in subset.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


@query(
    "s09_time_spine",
    f"""
    , spine as (
        select cast(unnest(generate_series(date '1995-01-01',
            date_trunc('year', {SQL_AS_OF}) + interval 3 year - interval 1 day,
            interval 1 day)) as date) as date_day)
    select date_day, count(order_id) as orders from spine
    left join ledger_orders on cast(created_at as date) = date_day group by date_day""",
)
def _(t):
    spine = time_spine(t.spark, "1995-01-01", as_of=AS_OF)
    daily = t.orders.groupBy(F.col("created_at").cast("date").alias("date_day")).agg(
        F.count("order_id").alias("found")
    )
    return spine.join(daily, "date_day", "left_outer").select(
        "date_day", F.coalesce("found", F.lit(0)).alias("orders")
    )


@query(
    "p09_renamed_projections",
    "select 'in' as direction, inventory_item_id as unit_id, product_id, created_at as moved_at "
    "from inventory_items union all "
    "select 'out', inventory_item_id, product_id, shipped_at from order_items "
    "where order_item_status in ('shipped', 'complete')",
)
def _(t):
    arrived = inbound_units(t.inventory_items).select(
        F.lit("in").alias("direction"),
        F.col("inbound_item_id").alias("unit_id"),
        F.col("inbound_product_id").alias("product_id"),
        F.col("received_at").alias("moved_at"),
    )
    left = outbound_units(t.order_items).select(
        F.lit("out").alias("direction"),
        F.col("outbound_item_id").alias("unit_id"),
        F.col("outbound_product_id").alias("product_id"),
        F.col("outbound_at").alias("moved_at"),
    )
    return arrived.unionByName(left)


@query(
    "p10_lateral_alias",
    "select order_item_id, lead_days, lead_days > 7 as is_late from ("
    "select order_item_id, cast(datediff('day', created_at, shipped_at) as integer) as lead_days "
    "from order_items)",
)
def _(t):
    return t.order_items.selectExpr(
        "order_item_id", "datediff(shipped_at, created_at) as lead_days",
        "lead_days > 7 as is_late",
    )


@query(
    "p11_derived_boolean",
    "select inventory_item_id, sold_at is null as is_unsold from inventory_items",
)
def _(t):
    return t.inventory_items.select(
        "inventory_item_id", F.col("sold_at").isNull().alias("is_unsold")
    )
