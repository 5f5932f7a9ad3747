"""The ledger tables and models as plain SQL over the test tables.

Each model is one common table expression. ``with_models`` puts the ones a query needs in
front of it. Evaluation date, split date and planted defects match ``sources.testbed``.
"""

from __future__ import annotations

import re

from ledgermill.sources.seeds import threshold_file

AS_OF = "timestamp '2001-08-01 00:00:00'"
TODAY = "date '2001-08-01'"
SPLIT = "timestamp '2001-01-01 00:00:00'"


def money(expr: str) -> str:
    return f"cast(round(sum(cast({expr} as decimal(18,2))), 2) as double)"


def years_apart(source: str) -> str:
    return f"cast(extract(year from {source}) as integer)"


MODELS: dict[str, str] = {}

MODELS["line_facts"] = """
    select *,
        case when status = 'Cancelled' or (l_linestatus = 'O' and l_returnflag = 'N') then null
             else l_shipdate end as shipped_at,
        case when status = 'Returned' then l_shipdate + interval 7 day end as returned_at
    from (
        select l.*,
            concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                      cast(l_quantity as integer)) as line_id,
            case when l_returnflag = 'R' then 'Returned'
                 when l_quantity = 1 then 'Cancelled'
                 when l_linestatus = 'F' then 'Complete'
                 when l_returnflag = 'A' then 'Shipped'
                 else 'Processing' end as status
        from lineitem l
    )"""

MODELS["all_order_items"] = """
    select line_id as id, l_orderkey as order_id, o_custkey as user_id, l_partkey as product_id,
        line_id as inventory_item_id, status, l_extendedprice as sale_price,
        o_orderdate as created_at, shipped_at, shipped_at + interval 3 day as delivered_at,
        returned_at
    from line_facts join orders on l_orderkey = o_orderkey"""

MODELS["all_orders"] = """
    select o_orderkey as order_id, o_custkey as user_id,
        case o_orderstatus when 'F' then 'Complete' when 'O' then 'Shipped'
            else 'Processing' end as status,
        case when o_custkey % 2 = 0 then 'F' else 'M' end as gender,
        o_orderdate as created_at, returned_at, shipped_at,
        shipped_at + interval 3 day as delivered_at,
        coalesce(line_count, 0)
            + case when o_orderstatus = 'O' and o_orderpriority = '1-URGENT' then 1 else 0 end
            as num_of_item
    from orders left join (
        select l_orderkey, count(*) as line_count, min(shipped_at) as shipped_at,
            max(returned_at) as returned_at
        from line_facts group by l_orderkey
    ) on o_orderkey = l_orderkey
    where not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')"""

MODELS["raw_products"] = """
    select p_partkey as id,
        cast(cast(p_retailprice as decimal(10,2)) - 150 as double) as cost,
        case p_type when 'ECONOMY' then 'Socks' when 'PROMO' then 'Swim'
            when 'STANDARD' then 'Jeans' when 'MEDIUM' then 'Dresses'
            when 'SMALL' then 'Suits' when 'LARGE' then 'Outerwear & Coats' end as category,
        p_name as name, p_brand as brand, p_retailprice as retail_price,
        case when p_partkey % 2 = 0 then 'Women' else 'Men' end as department,
        'SKU-' || p_partkey as sku, p_size as distribution_center_id
    from part"""

MODELS["raw_users"] = """
    select c_custkey as id, c_name as first_name, cast(null as varchar) as last_name,
        c_name || '@example.com' as email, cast(null as bigint) as age,
        case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
        cast(null as varchar) as state, cast(null as varchar) as street_address,
        cast(null as varchar) as postal_code, cast(null as varchar) as city, n_name as country,
        cast(null as double) as latitude, cast(null as double) as longitude,
        'Search' as traffic_source, timestamp '1995-01-01 00:00:00' as created_at,
        cast(null as varchar) as user_geom
    from customer left join nation on c_nationkey = n_nationkey"""

MODELS["all_inventory_items"] = """
    select line_id as id, l_partkey as product_id, o_orderdate - interval 45 day as created_at,
        case when status = 'Complete' then shipped_at end as sold_at,
        cast(cast(retail_price as decimal(10,2))
             + cast(round(l_discount * 100, 0) as integer) * 20 - 150 as double) as cost,
        category as product_category, name as product_name, brand as product_brand,
        retail_price as product_retail_price, department as product_department,
        sku as product_sku, distribution_center_id as product_distribution_center_id,
        o_orderdate as ordered_at
    from line_facts join orders on l_orderkey = o_orderkey
    join raw_products p on l_partkey = p.id"""

for _source, _test in (("raw", "<"), ("incr", ">=")):
    for _table, _when in (
        ("orders", "created_at"),
        ("order_items", "created_at"),
        ("inventory_items", "ordered_at"),
    ):
        _drop = " exclude (ordered_at)" if _table == "inventory_items" else ""
        MODELS[f"{_source}_{_table}"] = (
            f"select *{_drop} from all_{_table} where {_when} {_test} {SPLIT}"
        )

STAGED_ORDERS = """
    select cast(order_id as varchar) as order_id, cast(user_id as varchar) as user_id,
        lower(status) as order_status, lower(gender) as user_gender,
        num_of_item as number_of_items, created_at, returned_at, shipped_at, delivered_at
    from {source}"""

STAGED_ORDER_ITEMS = """
    select id as order_item_id, cast(order_id as varchar) as order_id,
        cast(user_id as varchar) as user_id, cast(product_id as varchar) as product_id,
        inventory_item_id, lower(status) as order_item_status, sale_price,
        created_at, shipped_at, delivered_at, returned_at
    from {source}"""

STAGED_INVENTORY = """
    select id as inventory_item_id, cast(product_id as varchar) as product_id,
        product_distribution_center_id, lower(product_category) as product_category,
        product_name, product_brand, lower(product_department) as product_department,
        product_sku, cost, product_retail_price, created_at, sold_at
    from {source}"""

for _source in ("raw", "incr"):
    for _table, _sql in (
        ("orders", STAGED_ORDERS),
        ("order_items", STAGED_ORDER_ITEMS),
        ("inventory_items", STAGED_INVENTORY),
    ):
        MODELS[f"stg_{_source}_{_table}"] = _sql.format(source=f"{_source}_{_table}")

MODELS["products"] = """
    select cast(id as varchar) as product_id,
        cast(distribution_center_id as varchar) as distribution_center_id,
        lower(category) as category, name, brand, department, sku, cost, retail_price
    from raw_products"""

MODELS["users"] = """
    select cast(id as varchar) as user_id, lower(first_name) as first_name,
        lower(last_name) as last_name, lower(email) as email, lower(gender) as gender,
        lower(state) as state, lower(street_address) as street_address, postal_code,
        lower(city) as city, lower(country) as country,
        lower(traffic_source) as traffic_source, age, latitude, longitude, created_at, user_geom
    from raw_users"""

for _name, _table in (
    ("ledger_orders", "orders"),
    ("order_items", "order_items"),
    ("inventory_items", "inventory_items"),
):
    MODELS[_name] = f"from stg_raw_{_table} union all by name from stg_incr_{_table}"

MODELS["price_history"] = """
    select cast(id as varchar) as product_id, cost,
        cast(cast(retail_price as decimal(10,2)) - v.discount as double) as retail_price,
        lower(category) as category, lower(brand) as brand, name as product_name,
        v.valid_from as dbt_valid_from, v.valid_to as dbt_valid_to
    from raw_products, (values
        (100, timestamp '1995-06-01 00:00:00', timestamp '1998-07-01 00:00:00'),
        (0, timestamp '1998-07-01 00:00:00', null)
    ) v(discount, valid_from, valid_to)
    where distribution_center_id <= 25"""



def _threshold_rows() -> str:
    lines = threshold_file().splitlines()[1:]
    quoted = [line.replace("'", "''").split(",", 3) for line in lines]
    return ", ".join(f"('{c}', '{tier}', {amount}, '{why}')" for c, tier, amount, why in quoted)


MODELS["thresholds"] = f"""
    select * from (values {_threshold_rows()})
        t(product_category, risk_tier, materiality_threshold, rationale)"""

MODELS["aggregated"] = f"""
    select order_id, user_id,
        string_agg(distinct order_item_status, ',' order by order_item_status)
            as order_item_status_list,
        count(*) as subledger_item_count,
        {money("sale_price")} as total_order_amount,
        min(created_at) as first_item_created_at,
        count(*) filter (where order_item_status = 'returned') as returned_item_count,
        {money("case when order_item_status = 'returned' then sale_price else 0 end")}
            as refund_amount,
        max(returned_at) as last_refund_at
    from order_items group by order_id, user_id"""

MODELS["joined"] = """
    select coalesce(i.order_id, o.order_id) as order_id,
        coalesce(i.user_id, o.user_id) as user_id,
        o.order_id as master_order_id, order_status as master_order_status,
        number_of_items as master_item_count, created_at, shipped_at, returned_at, delivered_at,
        i.order_id as subledger_order_id, order_item_status_list as subledger_order_status,
        subledger_item_count, total_order_amount, first_item_created_at, returned_item_count,
        refund_amount, last_refund_at
    from ledger_orders o full join aggregated i on i.order_id = o.order_id"""

MODELS["order_reconciliation"] = """
    select order_id, user_id, created_at as order_at, total_order_amount, master_item_count,
        subledger_item_count, returned_item_count, master_order_status, subledger_order_status,
        case when orphan then 'ERR: ORPHAN SUB-LEDGER' when missing then 'ERR: MISSING SUB-LEDGER'
            else 'RECONCILIATION SUCCESSFUL' end as order_reconciliation,
        case when orphan or missing then 'N/A - PREVIOUS ERROR'
            when coalesce(master_item_count, 0) = coalesce(subledger_item_count, 0)
            then 'INTEGRITY VERIFIED' else 'VARIANCE DETECTED' end as order_item_count_recon,
        case when orphan or missing then 'N/A - PREVIOUS ERROR'
            when master_order_status = subledger_order_status
            then 'INTEGRITY VERIFIED' else 'VARIANCE DETECTED' end as order_status_recon,
        case when orphan or missing then 'N/A - PREVIOUS ERROR'
            when master_order_status = subledger_order_status then 'INTEGRITY VERIFIED'
            when returned_item_count between 1 and subledger_item_count - 1
            then 'MIXED FULFILLMENT - PARTIAL REFUND'
            when returned_item_count = 0 and subledger_order_status like '%complete%'
                and subledger_order_status like '%shipped%'
            then 'MIXED FULFILLMENT - PARTIAL SHIPMENT'
            else 'VARIANCE DETECTED - UNEXPLAINED' end as order_status_recon_detail
    from (select *, master_order_id is null as orphan, subledger_order_id is null as missing
          from joined)"""

MODELS["revenue"] = """
    select order_id, user_id, created_at, shipped_at, total_order_amount as gross_revenue,
        coalesce(subledger_order_status, master_order_status) as order_status,
        case when shipped_at is null then 0 else total_order_amount end as recognized_revenue,
        coalesce(subledger_item_count, master_item_count) as total_item_count,
        case when master_order_id is null then 'ERR: ORPHAN SUB-LEDGER'
            when subledger_order_id is null then 'ERR: MISSING SUB-LEDGER'
            else 'MATCHED' end as data_integrity_status,
        case when shipped_at is null then 'SHIPPING_PENDING'
            when strftime(created_at, '%Y-%m') <> strftime(shipped_at, '%Y-%m')
            then 'POTENTIAL CUT-OFF RISK' else 'NORMAL' end as cutoff_status
    from joined"""

MODELS["refund_reconciliation"] = """
    select order_id, user_id, first_item_created_at as order_date,
        total_order_amount as gross_revenue, refund_amount,
        subledger_item_count as total_item_count, returned_item_count as total_returned_items,
        total_order_amount - refund_amount as net_revenue,
        round(coalesce(refund_amount / nullif(total_order_amount, 0), 0), 4)
            as refund_value_rate,
        round(coalesce(cast(returned_item_count as double)
                       / nullif(subledger_item_count, 0), 0), 4) as refund_count_rate,
        case when returned_item_count = 0 then 'NO REFUND'
            when returned_item_count = subledger_item_count then 'FULLY REFUNDED'
            else 'PARTIALLY REFUNDED' end as refund_type
    from aggregated"""

MODELS["order_item_revenue"] = """
    select order_item_id, order_id, user_id, i.product_id, category as product_category,
        brand as product_brand, name as product_name, order_item_status, sale_price,
        case when shipped_at is null then 0 else sale_price end as recognized_item_revenue,
        created_at, shipped_at, returned_at
    from order_items i left join products p on p.product_id = i.product_id"""

MODELS["inventory_sellthrough"] = f"""
    select inventory_item_id, product_id, product_category, product_brand, product_name, cost,
        product_retail_price, created_at, sold_at, sold_at is null as is_unsold,
        {years_apart("created_at")} as received_fiscal_year
    from inventory_items"""

MODELS["units"] = f"""
    select *, {years_apart("outbound_at")} as outbound_fiscal_year,
        {years_apart("inbound_at")} as inbound_fiscal_year
    from (
        select coalesce(i.inventory_item_id, o.inventory_item_id) as inventory_item_id,
            coalesce(i.product_id, o.product_id) as product_id,
            i.product_category, i.product_name, i.product_brand,
            case when i.created_at > o.shipped_at then o.shipped_at else i.created_at end
                as inbound_at,
            o.shipped_at as outbound_at, i.cost as historical_unit_cost,
            i.product_retail_price as current_market_price, o.sale_price,
            i.product_id as inbound_product_id, o.product_id as outbound_product_id
        from inventory_items i full join (
            select * from order_items
            where order_item_status not in ('cancelled', 'returned', 'processing')
        ) o on o.inventory_item_id = i.inventory_item_id
    )"""

MODELS["lifecycle"] = f"""
    select inventory_item_id, product_id, product_category, product_name, product_brand,
        inbound_at, outbound_at, historical_unit_cost, current_market_price, sale_price,
        least(historical_unit_cost, current_market_price) as lcm_unit_valuation,
        historical_unit_cost - least(historical_unit_cost, current_market_price)
            as inventory_valuation_loss,
        days_in_inventory,
        case when outbound_at is null then
            case when age > 4 then 'On-hand: 04. Obsolete (>4yr)'
                 when age > 3 then 'On-hand: 03. Slow-moving (3yr-4yr)'
                 when age > 2 then 'On-hand: 02. Stagnant (2yr-3yr)'
                 else 'On-hand: 01. Healthy (<2y)' end
        else
            case when age > 4 then 'Sold: 04. Very Slow (>4yr)'
                 when age > 3 then 'Sold: 03. Slow (3yr-4yr)'
                 when age > 2 then 'Sold: 02. Normal (2yr-3yr)'
                 else 'Sold: 01. Fast (<2y)' end
        end as aging_velocity_bucket,
        case when inventory_item_id is null then 'Error: Outbound without Inbound'
            when outbound_at is null then 'On-hand (Ending Inventory)'
            else 'Sold (COGS)' end as stock_status,
        case when inbound_product_id <> outbound_product_id then 'Product Not Match'
            else 'Product Match' end as product_match,
        outbound_fiscal_year, inbound_fiscal_year
    from (
        select *, days_in_inventory / 365.0 as age from (
            select *, cast(case when inbound_at is null then null
                when outbound_at is null
                then greatest(datediff('day', cast(inbound_at as date), {TODAY}), 0)
                else datediff('day', cast(inbound_at as date), cast(outbound_at as date))
                end as integer) as days_in_inventory
            from units))"""

MODELS["fiscal_years"] = """
    select inbound_fiscal_year as fiscal_year from units where inbound_fiscal_year is not null
    union
    select outbound_fiscal_year from units where outbound_fiscal_year is not null"""

MODELS["unit_years"] = f"""
    select y.fiscal_year, u.*, retail_price,
        least(make_date(y.fiscal_year, 12, 31), {TODAY}) as year_end,
        coalesce(outbound_fiscal_year = y.fiscal_year, false) as sold,
        coalesce(inbound_fiscal_year = y.fiscal_year, false) as bought,
        coalesce(inbound_fiscal_year <= y.fiscal_year
            and (outbound_fiscal_year is null or outbound_fiscal_year > y.fiscal_year), false)
            as on_hand,
        least(historical_unit_cost, coalesce(retail_price, current_market_price)) as carrying
    from fiscal_years y cross join units u
    left join price_history h on h.product_id = u.product_id
        and least(make_date(y.fiscal_year, 12, 31), {TODAY}) >= dbt_valid_from
        and (dbt_valid_to is null
             or least(make_date(y.fiscal_year, 12, 31), {TODAY}) < dbt_valid_to)"""


def _money_if(condition: str, expr: str) -> str:
    return money(f"case when {condition} then {expr} else 0 end")


MODELS["product_year_flow"] = f"""
    select fiscal_year, product_id, product_name, product_category, product_brand,
        count(inventory_item_id) filter (where sold) as period_units_sold,
        {_money_if("sold", "historical_unit_cost")} as period_cogs_amount,
        {_money_if("sold", "sale_price")} as period_revenue,
        count(inventory_item_id) filter (where on_hand) as ending_inv_qty,
        {_money_if("on_hand", "historical_unit_cost")} as ending_gross_inv_value,
        {_money_if("on_hand", "greatest(0, historical_unit_cost - carrying)")}
            as ending_allowance_lcm,
        {_money_if("on_hand", "carrying")} as ending_net_realizable_value,
        {_money_if("bought", "historical_unit_cost")} as period_purchase_amount,
        round(avg(datediff('day', cast(inbound_at as date), year_end))
              filter (where on_hand), 1) as avg_days_on_hand_at_year_end
    from unit_years group by all"""

MODELS["inventory_fiscal_report"] = """
    select fiscal_year, product_id, product_name, b.product_category, product_brand,
        period_units_sold, period_cogs_amount, period_revenue, beginning_inv_value,
        period_purchase_amount, ending_gross_inv_value, ending_inv_qty, ending_allowance_lcm,
        ending_net_realizable_value, avg_days_on_hand_at_year_end, risk_tier,
        materiality_threshold,
        case when abs(unexplained) <= 0.019 then 0 else round(unexplained, 2) end
            as audit_check_diff,
        round(period_cogs_amount
              / nullif((beginning_inv_value + ending_gross_inv_value) / 2, 0), 3)
            as inventory_turnover_ratio,
        round((period_revenue - period_cogs_amount) / nullif(period_revenue, 0), 4)
            as gross_profit_margin,
        case when avg_days_on_hand_at_year_end > 4 * 365 then 'Critical: Obsolete'
            when avg_days_on_hand_at_year_end > 2 * 365 then 'Warning: Slow Moving'
            when ending_net_realizable_value < ending_gross_inv_value - 0.01
            then 'Adjustment Required: NRV < Cost' else 'Healthy' end as inventory_risk_rating
    from (
        select *, beginning_inv_value + period_purchase_amount - ending_gross_inv_value
            - period_cogs_amount as unexplained
        from (
            select *, lag(ending_gross_inv_value, 1, 0)
                over (partition by product_id order by fiscal_year) as beginning_inv_value
            from product_year_flow
        )
    ) b left join thresholds t on t.product_category = b.product_category
    where period_purchase_amount > 0 or period_cogs_amount > 0 or ending_inv_qty > 0"""

# The marts as they were before the incremental tables arrived.
MODELS["base_aggregated"] = MODELS["aggregated"].replace("order_items", "stg_raw_order_items")
MODELS["base_refunds"] = MODELS["refund_reconciliation"].replace("aggregated", "base_aggregated")

_WORD = re.compile(r"[a-z_]+")


def with_models(sql: str, models: dict[str, str] = MODELS) -> str:
    """``sql`` preceded by the models it names, directly or through other models."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        for word in set(_WORD.findall(todo.pop())):
            if word in models and word not in needed:
                needed.add(word)
                todo.append(models[word])
    if not needed:
        return sql
    parts = [f"{name} as ({body.strip()}\n)" for name, body in models.items() if name in needed]
    return "with " + ",\n".join(parts) + "\n" + sql.strip()
