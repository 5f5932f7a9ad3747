"""Relational building blocks on the ledger tables: filters, joins, aggregates, windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgermill.catalog.prelude import AS_OF as SQL_AS_OF
from ledgermill.catalog.prelude import TODAY, money
from ledgermill.catalog.registry import query
from ledgermill.functions import (
    as_of_column,
    days_between,
    distinct_list,
    exact_sum,
    fiscal_year_end,
    guarded_ratio,
    money_sum,
    month_of,
    round_to,
)
from ledgermill.operators import inventory
from ledgermill.operators.fiscal import (
    cell_years,
    fiscal_years,
    product_year_flow,
    unit_cells,
    with_beginning_balance,
)
from ledgermill.operators.joins import as_of_join, full_outer, full_outer_many_to_one
from ledgermill.operators.orders import CUTOFF_RISK, PENDING, Lookback
from ledgermill.operators.prefix import running_sums
from ledgermill.operators.reports import by_severity
from ledgermill.operators.subset import sample_products
from ledgermill.session import staged
from ledgermill.sources.testbed import AS_OF

col = F.col


# filters and predicates


@query(
    "f01_comparisons",
    "select order_id, created_at, shipped_at from ledger_orders "
    "where shipped_at < created_at and order_status <> 'processing' and number_of_items >= 2",
)
def _(t):
    return t.orders.filter(
        (col("shipped_at") < col("created_at"))
        & (col("order_status") != "processing")
        & (col("number_of_items") >= 2)
    ).select("order_id", "created_at", "shipped_at")


@query(
    "f02_null_tests",
    "select order_item_id, order_item_status from order_items "
    "where shipped_at is not null and returned_at is null",
)
def _(t):
    return t.order_items.filter(
        col("shipped_at").isNotNull() & col("returned_at").isNull()
    ).select("order_item_id", "order_item_status")


@query(
    "f03_not_in_list",
    "select order_item_id, order_item_status from order_items "
    "where order_item_status not in ('cancelled', 'returned', 'processing')",
)
def _(t):
    return t.order_items.filter(
        ~col("order_item_status").isin(*inventory.NOT_OUTBOUND)
    ).select("order_item_id", "order_item_status")


@query(
    "f04_in_subquery",
    "select order_id, order_status from ledger_orders where order_id in "
    "(select order_id from order_items where order_item_status = 'cancelled')",
)
def _(t):
    cancelled = t.order_items.filter(col("order_item_status") == "cancelled").select("order_id")
    return t.orders.join(cancelled, "order_id", "left_semi").select("order_id", "order_status")


@query(
    "f05_like",
    "select order_id, order_item_status_list from aggregated "
    "where order_item_status_list like '%shipped%' and order_item_status_list like '%complete%'",
)
def _(t):
    statuses = col("order_item_status_list")
    return t.aggregated.filter(
        statuses.contains("shipped") & statuses.contains("complete")
    ).select("order_id", "order_item_status_list")


@query(
    "f06_boolean_trees",
    "select order_item_id from order_items where (order_item_status = 'complete' "
    "or sale_price > 50000) and not (shipped_at < created_at)",
)
def _(t):
    wanted = (col("order_item_status") == "complete") | (col("sale_price") > 50000)
    return t.order_items.filter(wanted & ~(col("shipped_at") < col("created_at"))).select(
        "order_item_id"
    )


@query(
    "f07_lookback",
    f"select order_item_id, created_at, shipped_at, returned_at from order_items "
    f"where created_at >= {SQL_AS_OF} - interval 14 day "
    f"or shipped_at >= {SQL_AS_OF} - interval 14 day "
    f"or returned_at >= {SQL_AS_OF} - interval 14 day",
)
def _(t):
    recent = Lookback(AS_OF).touched("created_at", "shipped_at", "returned_at")
    return t.order_items.filter(recent).select(
        "order_item_id", "created_at", "shipped_at", "returned_at"
    )


@query(
    "f08_filter_after_aggregate",
    "select user_id, count(*) as orders from ledger_orders group by user_id having count(*) > 10",
)
def _(t):
    return (
        t.orders.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("orders"))
        .filter(col("orders") > 10)
    )


@query(
    "f09_validity_interval",
    f"select product_id, retail_price from price_history "
    f"where {SQL_AS_OF} - interval 4 year >= dbt_valid_from "
    f"and (dbt_valid_to is null or {SQL_AS_OF} - interval 4 year < dbt_valid_to)",
)
def _(t):
    instant = F.lit("1997-08-01 00:00:00").cast("timestamp")
    valid = (instant >= col("dbt_valid_from")) & (
        col("dbt_valid_to").isNull() | (instant < col("dbt_valid_to"))
    )
    return t.price_history.filter(valid).select("product_id", "retail_price")


# joins


@query(
    "j01_full_outer_ledgers",
    "select i.order_id as line_order, o.order_id as header_order, subledger_item_count, "
    "number_of_items from aggregated i full join ledger_orders o on i.order_id = o.order_id",
)
def _(t):
    lines = t.aggregated.select(col("order_id").alias("line_order"), "subledger_item_count")
    headers = t.orders.select(col("order_id").alias("header_order"), "number_of_items")
    return full_outer(lines, headers, "line_order", "header_order")


@query(
    "j02_full_outer_units",
    "select i.inventory_item_id as inbound_item_id, o.inventory_item_id as outbound_item_id, "
    "i.created_at as received_at, o.shipped_at as outbound_at from inventory_items i full join "
    "(select * from order_items where order_item_status in ('shipped', 'complete')) o "
    "on o.inventory_item_id = i.inventory_item_id",
)
def _(t):
    arrived = inventory.inbound_units(t.inventory_items).select("inbound_item_id", "received_at")
    left = inventory.outbound_units(t.order_items).select("outbound_item_id", "outbound_at")
    return full_outer_many_to_one(left, arrived, "outbound_item_id", "inbound_item_id")


@query(
    "j03_left_enrichment",
    "select order_item_id, i.product_id, category, brand from order_items i "
    "left join products p on p.product_id = i.product_id",
)
def _(t):
    return t.order_items.join(
        t.products.select("product_id", "category", "brand"), "product_id", "left_outer"
    ).select("order_item_id", "product_id", "category", "brand")


@query(
    "j04_years_by_units",
    "select fiscal_year, product_id, count(*) as units_in_life, "
    "count(*) filter (where on_hand) as units_on_hand from ("
    "select y.fiscal_year, product_id, inbound_fiscal_year <= y.fiscal_year and "
    "(outbound_fiscal_year is null or outbound_fiscal_year > y.fiscal_year) as on_hand "
    "from fiscal_years y cross join units where inbound_fiscal_year <= y.fiscal_year "
    "and (outbound_fiscal_year is null or outbound_fiscal_year >= y.fiscal_year)) group by all",
)
def _(t):
    cells = staged(unit_cells(t.lifecycle), "unit-cells")
    left, year = col("outbound_fiscal_year"), col("fiscal_year")
    on_hand = left.isNull() | (left > year)
    return (
        cell_years(cells, fiscal_years(cells))
        .groupBy("fiscal_year", "product_id")
        .agg(
            F.sum("units").alias("units_in_life"),
            F.sum(F.when(on_hand, col("units")).otherwise(F.lit(0))).alias("units_on_hand"),
        )
    )


@query(
    "j05_as_of_join",
    "select order_item_id, i.product_id, created_at, h.retail_price from order_items i "
    "left join price_history h on h.product_id = i.product_id and created_at >= dbt_valid_from "
    "and (dbt_valid_to is null or created_at < dbt_valid_to)",
)
def _(t):
    prices = t.price_history.select("product_id", "retail_price", "dbt_valid_from", "dbt_valid_to")
    facts = t.order_items.select("order_item_id", "product_id", "created_at")
    return as_of_join(facts, prices, "product_id", col("created_at"))


@query(
    "j05_hot_as_of",
    """, placed as (
        select order_item_status as status, cast(created_at as date) as day, count(*) as lines
        from order_items where created_at is not null and order_item_status is not null
        group by 1, 2)
    select order_item_id, order_item_status, shipped_at, lines
    from order_items asof left join placed
        on status = order_item_status and shipped_at >= day""",
)
def _(t):
    """Few keys, each with thousands of versions and up to half of all facts."""
    day = col("created_at").cast("date").cast("timestamp")
    placed = (
        t.order_items.filter(col("created_at").isNotNull())
        .groupBy("order_item_status", day.alias("valid_from"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    in_order = Window.partitionBy("order_item_status").orderBy("valid_from")
    history = placed.withColumn("valid_to", F.lead("valid_from").over(in_order))
    facts = t.order_items.select("order_item_id", "order_item_status", "shipped_at")
    return as_of_join(
        facts, history, "order_item_status", col("shipped_at"), "valid_from", "valid_to", 10_000
    )


@query(
    "j06_lookup_join",
    "select product_id, category, risk_tier, materiality_threshold from products "
    "left join thresholds t on t.product_category = category",
)
def _(t):
    tiers = t.thresholds.select(
        col("product_category").alias("category"), "risk_tier", "materiality_threshold"
    )
    return t.products.join(tiers, "category", "left_outer").select(
        "product_id", "category", "risk_tier", "materiality_threshold"
    )


@query(
    "j07_join_back_to_aggregate",
    "select r.order_id, order_status_recon, order_item_status_list from order_reconciliation r "
    "left join aggregated i on i.order_id = r.order_id",
)
def _(t):
    lines = t.aggregated.select("order_id", "order_item_status_list")
    return t.order_reconciliation.join(lines, "order_id", "left_outer").select(
        "order_id", "order_status_recon", "order_item_status_list"
    )


@query(
    "j08_semi_join",
    f"select * from ledger_orders where order_id in (select order_id from order_items "
    f"where returned_at >= {SQL_AS_OF} - interval 14 day)",
)
def _(t):
    returned = t.order_items.filter(Lookback(AS_OF).touched("returned_at")).select("order_id")
    return t.orders.join(returned, "order_id", "left_semi")


@query(
    "j09_inner_join",
    "select distinct o.order_id, order_status from ledger_orders o "
    "join order_items i on i.order_id = o.order_id join products p "
    "on p.product_id = i.product_id where category = 'socks'",
)
def _(t):
    socks = t.products.filter(col("category") == "socks").select("product_id")
    lines = t.order_items.join(socks, "product_id", "inner").select("order_id").distinct()
    return t.orders.join(lines, "order_id", "inner").select("order_id", "order_status")


@query(
    "j10_anti_join",
    "select order_item_id, order_id from order_items "
    "where order_id not in (select order_id from ledger_orders)",
)
def _(t):
    return t.order_items.join(t.orders.select("order_id"), "order_id", "left_anti").select(
        "order_item_id", "order_id"
    )


# aggregates


@query(
    "a01_group_by",
    "select order_status, user_gender, count(*) as orders, "
    "cast(sum(number_of_items) as bigint) as items from ledger_orders group by 1, 2",
)
def _(t):
    return t.orders.groupBy("order_status", "user_gender").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("number_of_items").alias("items")
    )


@query("a02_count", "select product_id, count(*) as lines from order_items group by product_id")
def _(t):
    return t.order_items.groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "a03_conditional_count",
    "select product_id, count(*) filter (where order_item_status = 'returned') as returned, "
    "count(*) filter (where shipped_at < created_at) as early from order_items group by 1",
)
def _(t):
    return t.order_items.groupBy("product_id").agg(
        F.count_if(col("order_item_status") == "returned").alias("returned"),
        F.count_if(col("shipped_at") < col("created_at")).alias("early"),
    )


@query(
    "a04_rounded_sum",
    f"select user_id, {money('sale_price')} as spent from order_items group by user_id",
)
def _(t):
    return t.order_items.groupBy("user_id").agg(money_sum(col("sale_price")).alias("spent"))


@query(
    "a05_conditional_sum",
    f"""select user_id,
        {money("case when order_item_status = 'returned' then sale_price else 0 end")}
            as refunded,
        {money("case when shipped_at is null then sale_price else 0 end")} as unshipped
    from order_items group by user_id""",
)
def _(t):
    price = col("sale_price")
    returned = F.when(col("order_item_status") == "returned", price).otherwise(0.0)
    unshipped = F.when(col("shipped_at").isNull(), price).otherwise(0.0)
    return t.order_items.groupBy("user_id").agg(
        money_sum(returned).alias("refunded"), money_sum(unshipped).alias("unshipped")
    )


@query(
    "a06_min_max",
    "select order_id, min(created_at) as first_at, max(returned_at) as last_at "
    "from order_items group by order_id",
)
def _(t):
    return t.order_items.groupBy("order_id").agg(
        F.min("created_at").alias("first_at"), F.max("returned_at").alias("last_at")
    )


@query(
    "a07_conditional_average",
    "select product_category, round(avg(case when outbound_at is not null "
    "then days_in_inventory end), 1) as avg_days_to_ship from lifecycle group by 1",
)
def _(t):
    shipped_days = F.when(col("outbound_at").isNotNull(), col("days_in_inventory"))
    return t.lifecycle.groupBy("product_category").agg(
        round_to(F.avg(shipped_days), 1).alias("avg_days_to_ship")
    )


@query(
    "a08_distinct_list",
    "select user_id, string_agg(distinct order_item_status, ',' order by order_item_status) "
    "as statuses from order_items group by user_id",
)
def _(t):
    return t.order_items.groupBy("user_id").agg(
        distinct_list(col("order_item_status")).alias("statuses")
    )


@query(
    "a09_count_distinct",
    "select product_id, count(distinct order_id) as orders, count(distinct user_id) as users "
    "from order_items group by product_id",
)
def _(t):
    return t.order_items.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("orders"), F.count_distinct("user_id").alias("users")
    )


@query(
    "a10_global_aggregate",
    "select count(*) as shipped, round(cast(count(*) filter (where shipped_at < created_at) "
    "as double) / nullif(count(*), 0), 4) as early_rate from order_items "
    "where shipped_at is not null",
)
def _(t):
    early = F.count_if(col("shipped_at") < col("created_at")).cast("double")
    rate = guarded_ratio(early, F.count(F.lit(1)))
    return t.order_items.filter(col("shipped_at").isNotNull()).agg(
        F.count(F.lit(1)).alias("shipped"), round_to(rate, 4).alias("early_rate")
    )


@query("a11_distinct", "select distinct product_id, order_item_status from order_items")
def _(t):
    return t.order_items.select("product_id", "order_item_status").distinct()


@query(
    "a12_guarded_ratio",
    "select order_id, returned_item_count / nullif(returned_item_count - 1, 0) as ratio, "
    "round(coalesce(refund_amount / nullif(total_order_amount, 0), 0), 4) as value_rate "
    "from aggregated",
)
def _(t):
    returned = col("returned_item_count")
    value_rate = guarded_ratio(col("refund_amount"), col("total_order_amount"))
    return t.aggregated.select(
        "order_id",
        guarded_ratio(returned, returned - 1).alias("ratio"),
        round_to(F.coalesce(value_rate, F.lit(0.0)), 4).alias("value_rate"),
    )


@query(
    "a13_ratio_of_sums",
    f"select order_date, {money('refund_amount')} / nullif({money('gross_revenue')}, 0) as rate "
    f"from refund_reconciliation group by order_date",
)
def _(t):
    return t.refund_reconciliation.groupBy("order_date").agg(
        guarded_ratio(
            money_sum(col("refund_amount")), money_sum(col("gross_revenue"))
        ).alias("rate")
    )


# windows


@query(
    "w01_lag_with_default",
    "select product_id, fiscal_year, ending_gross_inv_value, "
    "lag(ending_gross_inv_value, 1, 0) over (partition by product_id order by fiscal_year) "
    "as beginning_inv_value from product_year_flow",
)
def _(t):
    cells = staged(unit_cells(t.lifecycle), "unit-cells")
    flow = product_year_flow(cells, t.price_history, AS_OF)
    return with_beginning_balance(flow).select(
        "product_id", "fiscal_year", "ending_gross_inv_value", "beginning_inv_value"
    )


@query(
    "w02_running_total",
    f"select order_status, day, cast(sum(amount) over (partition by order_status order by day "
    f"rows unbounded preceding) as double) as running from ("
    f"select order_status, cast(created_at as date) as day, "
    f"sum(cast(gross_revenue as decimal(18,2))) as amount from revenue "
    f"where created_at is not null group by 1, 2)",
)
def _(t):
    daily = (
        t.revenue.filter(col("created_at").isNotNull())
        .groupBy("order_status", col("created_at").cast("date").alias("day"))
        .agg(exact_sum(col("gross_revenue")).alias("amount"))
    )
    return running_sums(daily, ["order_status"], "day", ["amount"]).select(
        "order_status", "day", col("running_amount").cast("double").alias("running")
    )


@query(
    "w02_daily_total",
    """select day, cast(sum(amount) over (order by day rows unbounded preceding) as double)
        as running, lead(day) over (order by day) as next_day
    from (select cast(created_at as date) as day, sum(cast(sale_price as decimal(18,2))) as amount
        from order_items where created_at is not null group by 1)""",
)
def _(t):
    """A total without a group: blocks of days, no window over the whole calendar's rows."""
    daily = (
        t.order_items.filter(col("created_at").isNotNull())
        .groupBy(col("created_at").cast("date").alias("day"))
        .agg(exact_sum(col("sale_price")).alias("amount"))
    )
    return running_sums(daily, [], "day", ["amount"]).select(
        "day", col("running_amount").cast("double").alias("running"), "next_day"
    )


@query(
    "w03_month_offset",
    """, monthly as (
        select product_category, date_trunc('month', received) as month, count(*) as units
        from (select product_category, created_at as received from inventory_items)
        group by 1, 2)
    select n.product_category, cast(n.month as date) as month, n.units,
        p.units as units_month_before
    from monthly n left join monthly p on p.product_category = n.product_category
        and p.month = n.month - interval 1 month""",
)
def _(t):
    received = month_of(col("created_at")).cast("date").alias("month")
    monthly = t.inventory_items.groupBy("product_category", received).agg(
        F.count(F.lit(1)).alias("units")
    )
    before = monthly.select(
        "product_category",
        F.add_months("month", 1).alias("month"),
        col("units").alias("units_month_before"),
    )
    return monthly.join(before, ["product_category", "month"], "left_outer")


# order, limit, set operations


@query(
    "o01_severity_order",
    "select order_id, cutoff_status, gross_revenue from revenue order by case cutoff_status "
    "when 'POTENTIAL CUT-OFF RISK' then 1 when 'SHIPPING_PENDING' then 2 else 3 end, "
    "gross_revenue desc, order_id",
)
def _(t):
    # the key at the end spreads equal amounts over range partitions
    return t.revenue.orderBy(
        by_severity("cutoff_status", CUTOFF_RISK, PENDING),
        col("gross_revenue").desc(),
        "order_id",
    ).select("order_id", "cutoff_status", "gross_revenue")


@query(
    "o02_nulls_last",
    "select order_id, shipped_at from ledger_orders order by shipped_at desc nulls last, order_id",
)
def _(t):
    return t.orders.select("order_id", "shipped_at").orderBy(
        col("shipped_at").desc_nulls_last(), col("order_id").asc_nulls_last()
    )


@query(
    "o03_random_sample",
    "select product_id from (select distinct product_id from order_items) "
    "order by md5(product_id || '42'), product_id limit 50",
)
def _(t):
    return sample_products(t.order_items, 50, "42")


@query("o04_latest_first", "select order_id, created_at from ledger_orders order by 2 desc, 1")
def _(t):
    return t.orders.select("order_id", "created_at").orderBy(
        col("created_at").desc(), "order_id"
    )


@query(
    "u01_union_all",
    "select order_id from stg_raw_orders union all select order_id from stg_incr_orders",
)
def _(t):
    return t.staged("raw_orders").unionByName(t.staged("incr_orders")).select("order_id")


@query("u02_union_distinct", "select cast(fiscal_year as integer) as fiscal_year from fiscal_years")
def _(t):
    years = F.array("inbound_fiscal_year", "outbound_fiscal_year")
    return (
        t.lifecycle.select(F.explode(years).alias("fiscal_year"))
        .filter(col("fiscal_year").isNotNull())
        .distinct()
    )


# scalar functions


@query(
    "x01_casts",
    "select cast(o_orderkey as varchar) as order_id, cast(o_orderdate as date) as day, "
    "cast(o_totalprice as decimal(18,2)) as amount, cast(o_custkey as double) as customer "
    "from orders",
)
def _(t):
    return t.table("orders").select(
        col("o_orderkey").cast("string").alias("order_id"),
        col("o_orderdate").cast("date").alias("day"),
        col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        col("o_custkey").cast("double").alias("customer"),
    )


@query("x02_lower", "select p_partkey, lower(p_brand) as brand, lower(p_type) as kind from part")
def _(t):
    return t.table("part").select(
        "p_partkey", F.lower("p_brand").alias("brand"), F.lower("p_type").alias("kind")
    )


@query(
    "x03_coalesce",
    "select order_id, coalesce(subledger_order_status, master_order_status) as status, "
    "coalesce(subledger_item_count, master_item_count, 0) as items from joined",
)
def _(t):
    return t.joined.select(
        "order_id",
        F.coalesce("subledger_order_status", "master_order_status").alias("status"),
        F.coalesce("subledger_item_count", "master_item_count", F.lit(0)).alias("items"),
    )


@query(
    "x04_nullif",
    "select order_id, nullif(returned_item_count, 0) as returned from aggregated",
)
def _(t):
    return t.aggregated.select(
        "order_id", F.nullif(col("returned_item_count"), F.lit(0)).alias("returned")
    )


@query(
    "x05_round",
    "select order_id, round(total_order_amount / subledger_item_count, 2) as per_item, "
    "round(total_order_amount, 1) as amount_1 from aggregated",
)
def _(t):
    amount = col("total_order_amount")
    return t.aggregated.select(
        "order_id",
        round_to(amount / col("subledger_item_count"), 2).alias("per_item"),
        round_to(amount, 1).alias("amount_1"),
    )


@query(
    "x06_abs",
    "select order_id, abs(master_item_count - subledger_item_count) as gap from joined",
)
def _(t):
    gap = col("master_item_count") - col("subledger_item_count")
    return t.joined.select("order_id", F.abs(gap).alias("gap"))


@query(
    "x07_greatest_least",
    "select order_item_id, greatest(shipped_at, returned_at) as last_move, "
    "least(created_at, shipped_at) as first_move from order_items",
)
def _(t):
    return t.order_items.select(
        "order_item_id",
        F.greatest("shipped_at", "returned_at").alias("last_move"),
        F.least("created_at", "shipped_at").alias("first_move"),
    )


@query(
    "x08_case",
    "select order_id, case when subledger_item_count > 5 then case when returned_item_count > 0 "
    "then 'large returned' else 'large' end when subledger_item_count > 2 then 'medium' "
    "else 'small' end as size from aggregated",
)
def _(t):
    items = col("subledger_item_count")
    large = F.when(col("returned_item_count") > 0, "large returned").otherwise("large")
    size = F.when(items > 5, large).when(items > 2, "medium").otherwise("small")
    return t.aggregated.select("order_id", size.alias("size"))


@query(
    "x09_year",
    "select cast(extract(year from created_at) as integer) as year, count(*) as orders "
    "from ledger_orders group by 1",
)
def _(t):
    return t.orders.groupBy(F.year("created_at").alias("year")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query(
    "x10_month",
    "select order_id, date_trunc('month', created_at) as month from ledger_orders",
)
def _(t):
    return t.orders.select("order_id", month_of(col("created_at")).alias("month"))


@query(
    "x11_days_between",
    "select order_item_id, cast(datediff('day', cast(created_at as date), "
    "cast(shipped_at as date)) as integer) as days from order_items",
)
def _(t):
    return t.order_items.select(
        "order_item_id", days_between(col("created_at"), col("shipped_at")).alias("days")
    )


@query(
    "x12_timestamp_days",
    "select order_item_id, cast(datediff('day', created_at + interval 20 hour, "
    "returned_at + interval 4 hour) as integer) as days from order_items",
)
def _(t):
    evening = col("created_at") + F.make_dt_interval(hours=F.lit(20))
    morning = col("returned_at") + F.make_dt_interval(hours=F.lit(4))
    return t.order_items.select("order_item_id", days_between(evening, morning).alias("days"))


@query(
    "x13_date_difference",
    f"select order_id, cast({TODAY} - cast(created_at as date) as integer) as age "
    f"from ledger_orders",
)
def _(t):
    today = F.lit(AS_OF).cast("date")
    return t.orders.select("order_id", days_between(col("created_at"), today).alias("age"))


@query(
    "x14_fiscal_year_end",
    f"select distinct fiscal_year, least(make_date(fiscal_year, 12, 31), {TODAY}) as year_end "
    f"from (select cast(extract(year from created_at) as integer) as fiscal_year "
    f"from ledger_orders)",
)
def _(t):
    year = F.year("created_at").alias("fiscal_year")
    return (
        t.orders.select(year)
        .distinct()
        .withColumn("year_end", fiscal_year_end(col("fiscal_year"), AS_OF))
    )


@query(
    "x15_concat",
    "select product_id, brand || ' / ' || name as label, "
    "cast(2000 as varchar) || '-12-31' as day from products",
)
def _(t):
    return t.products.select(
        "product_id",
        F.concat("brand", F.lit(" / "), "name").alias("label"),
        F.concat(F.lit(2000).cast("string"), F.lit("-12-31")).alias("day"),
    )


@query(
    "x16_as_of",
    f"select order_id, created_at > {SQL_AS_OF} as in_future, "
    f"cast({SQL_AS_OF} as date) as today from ledger_orders",
)
def _(t):
    now = as_of_column(AS_OF)
    return t.orders.select(
        "order_id",
        (col("created_at") > now).alias("in_future"),
        now.cast("date").alias("today"),
    )


@query(
    "x17_arithmetic",
    "select order_id, subledger_item_count / 2 as half, subledger_item_count * 3 - 1 as triple, "
    "total_order_amount - refund_amount as net from aggregated",
)
def _(t):
    items = col("subledger_item_count")
    return t.aggregated.select(
        "order_id",
        (items / 2).alias("half"),
        (items * 3 - 1).alias("triple"),
        (col("total_order_amount") - col("refund_amount")).alias("net"),
    )
