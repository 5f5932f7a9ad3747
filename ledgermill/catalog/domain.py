"""Intermediate models, marts, audit reports, controls and dashboard feeds."""

from ledgermill.catalog.prelude import money
from ledgermill.catalog.registry import query
from ledgermill.operators import controls, feeds, reports

MODEL_QUERIES = {
    "d01_union_order_items": "order_items",
    "d02_aggregate_order_items": "aggregated",
    "d03_join_master_subledger": "joined",
    "d04_union_inventory_items": "inventory_items",
    "d05_inventory_lifecycle": "lifecycle",
    "d06_order_reconciliation": "order_reconciliation",
    "d07_revenue": "revenue",
    "d08_refund_reconciliation": "refund_reconciliation",
    "d09_order_item_revenue": "order_item_revenue",
    "d10_inventory_sellthrough": "inventory_sellthrough",
    "d11_inventory_fiscal_report": "inventory_fiscal_report",
}

for _name, _model in MODEL_QUERIES.items():
    query(_name, f"select * from {_model}")(lambda t, model=_model: getattr(t, model))


# audit exception reports


@query(
    "d13_inventory_exceptions",
    """
    select fiscal_year, product_id, product_name, product_category, product_brand,
        audit_check_diff, ending_gross_inv_value, ending_net_realizable_value,
        ending_allowance_lcm, inventory_risk_rating, avg_days_on_hand_at_year_end,
        inventory_turnover_ratio, gross_profit_margin,
        case when audit_check_diff <> 0 then 'INVENTORY EQUATION IMBALANCE'
            else case inventory_risk_rating when 'Critical: Obsolete' then 'OBSOLETE STOCK'
                when 'Warning: Slow Moving' then 'SLOW-MOVING STOCK'
                else 'LCM WRITE-DOWN REQUIRED' end end as exception_type
    from inventory_fiscal_report
    where not (audit_check_diff = 0 and inventory_risk_rating = 'Healthy')""",
)
def _(t):
    return reports.inventory_exceptions(t.inventory_fiscal_report)


@query(
    "d14_order_reconciliation_failures",
    """
    select order_id, user_id, order_at, total_order_amount, master_item_count,
        subledger_item_count, master_item_count - subledger_item_count as item_count_variance,
        order_reconciliation as existence_check, order_item_count_recon as item_count_check,
        order_status_recon as status_check
    from order_reconciliation
    where order_reconciliation like 'ERR%' or order_item_count_recon like 'VARIANCE%'
        or order_status_recon like 'VARIANCE%'""",
)
def _(t):
    return reports.order_reconciliation_failures(t.order_reconciliation)


@query(
    "d15_revenue_cutoff_risk",
    """
    select order_id, user_id, order_status, created_at, shipped_at, gross_revenue,
        recognized_revenue, gross_revenue - recognized_revenue as unrecognized_amount,
        data_integrity_status, cutoff_status, date_trunc('month', created_at) as order_month,
        date_trunc('month', shipped_at) as ship_month
    from revenue where not (cutoff_status = 'NORMAL' and data_integrity_status = 'MATCHED')""",
)
def _(t):
    return reports.revenue_cutoff_risk(t.revenue)


@query(
    "d16_refund_anomalies",
    """
    select * from (
        select *, case when refund_type = 'PARTIALLY REFUNDED'
                then 'PARTIAL REFUND - MIXED STATUS ORDER'
            when gross_revenue >= 100 then 'FULL REFUND - HIGH VALUE ORDER' end as anomaly_flag
        from refund_reconciliation where refund_type <> 'NO REFUND'
    ) where anomaly_flag is not null""",
)
def _(t):
    return reports.refund_anomalies(t.refund_reconciliation)


@query(
    "d17_fulfillment_lead_time_anomalies",
    """
    select order_item_id, order_id, user_id, product_id, order_item_status, sale_price,
        created_at, shipped_at,
        cast(datediff('day', created_at, shipped_at) as integer) as lead_time_days,
        if(shipped_at < created_at, 'NEGATIVE LEAD TIME - IMPOSSIBLE SEQUENCE',
           'EXCESSIVE LEAD TIME - OVER 7 DAYS') as anomaly_flag
    from order_item_revenue
    where shipped_at < created_at or datediff('day', created_at, shipped_at) > 7""",
)
def _(t):
    return reports.fulfillment_lead_time_anomalies(t.order_item_revenue)


# controls


@query(
    "d18_unsuccessful_reconciliation",
    "select order_id, order_reconciliation, master_item_count, subledger_item_count "
    "from order_reconciliation where order_reconciliation like 'ERR%'",
)
def _(t):
    return controls.unsuccessful_reconciliation(t.order_reconciliation)


@query(
    "d19_unexpected_order_variance",
    """
    select order_id, master_item_count, subledger_item_count, order_item_count_recon,
        order_status_recon
    from order_reconciliation
    where order_item_count_recon = 'VARIANCE DETECTED'
        or order_status_recon_detail = 'VARIANCE DETECTED - UNEXPLAINED'""",
)
def _(t):
    return controls.unexpected_order_variance(t.order_reconciliation, t.aggregated)


@query(
    "d20_wrong_revenue_recognition",
    "select order_id, shipped_at, recognized_revenue, gross_revenue from revenue "
    "where case when shipped_at is null then recognized_revenue <> 0 "
    "else recognized_revenue = 0 and gross_revenue > 0 end",
)
def _(t):
    return controls.wrong_revenue_recognition(t.revenue)


@query(
    "d21_lead_time_above_baseline",
    """
    select * from (
        select count(*) as total_shipped,
            count(*) filter (where shipped_at < created_at) as negative_lead_time_count,
            round(cast(count(*) filter (where shipped_at < created_at) as double)
                  / nullif(count(*), 0), 4) as negative_lead_time_rate
        from order_item_revenue where shipped_at is not null
    ) where negative_lead_time_rate > 0.15""",
)
def _(t):
    return controls.lead_time_above_baseline(t.order_item_revenue)


# dashboard feeds


@query(
    "d22_monthly_revenue",
    f"""
    select date_trunc('month', created_at) as order_month,
        {money("gross_revenue")} as gross_revenue,
        {money("recognized_revenue")} as recognized_revenue, count(*) as order_count,
        count(*) filter (where cutoff_status = 'POTENTIAL CUT-OFF RISK') as cutoff_risk_orders
    from revenue group by 1""",
)
def _(t):
    return feeds.monthly_revenue(t.revenue)


@query(
    "d23_reconciliation_status",
    """
    select order_reconciliation, order_item_count_recon, order_status_recon_detail,
        case when order_reconciliation like 'ERR%' or order_item_count_recon like 'VARIANCE%'
                or order_status_recon_detail like 'VARIANCE%' then 'genuine'
            when order_status_recon_detail like 'MIXED%' then 'benign'
            else 'clean' end as variance_kind,
        count(*) as order_count
    from order_reconciliation group by all""",
)
def _(t):
    return feeds.reconciliation_status(t.order_reconciliation)


@query(
    "d24_refund_rate_trend",
    f"""
    select order_month, gross_revenue, refund_amount,
        round(refund_amount / nullif(gross_revenue, 0), 4) as refund_rate
    from (select date_trunc('month', order_date) as order_month,
              {money("gross_revenue")} as gross_revenue,
              {money("refund_amount")} as refund_amount
          from refund_reconciliation group by 1)""",
)
def _(t):
    return feeds.refund_rate_trend(t.refund_reconciliation)


@query(
    "d24_return_rate_by_category",
    """
    select product_category, count(*) as item_count,
        count(*) filter (where order_item_status = 'returned') as returned_count,
        round(avg(case when order_item_status = 'returned' then 1.0 else 0.0 end), 4)
            as return_rate
    from order_item_revenue group by 1""",
)
def _(t):
    return feeds.return_rate_by_category(t.order_item_revenue)


@query(
    "d24_lead_time_integrity",
    "select if(shipped_at < created_at, 'negative', 'valid') as lead_time, "
    "count(*) as item_count from order_item_revenue where shipped_at is not null group by 1",
)
def _(t):
    return feeds.lead_time_integrity(t.order_item_revenue)


@query(
    "d25_inventory_controls",
    f"""
    select fiscal_year, {money("ending_gross_inv_value")} as ending_gross_inv_value,
        {money("ending_allowance_lcm")} as lcm_write_down,
        count(*) filter (where abs(audit_check_diff) > materiality_threshold)
            as materiality_breaches,
        round(cast(sum(cast(avg_days_on_hand_at_year_end as decimal(18,1)) * ending_inv_qty)
                   as double)
              / nullif(sum(ending_inv_qty)
                       filter (where avg_days_on_hand_at_year_end is not null), 0), 1)
            as avg_days_on_hand
    from inventory_fiscal_report group by 1""",
)
def _(t):
    return feeds.inventory_controls(t.inventory_fiscal_report)


@query(
    "d26_unsold_share",
    """
    select received_fiscal_year, count(*) as units_received,
        count(*) filter (where is_unsold) as units_unsold,
        round(avg(case when is_unsold then 1.0 else 0.0 end), 4) as unsold_share
    from inventory_sellthrough group by 1""",
)
def _(t):
    return feeds.unsold_share(t.inventory_sellthrough)
