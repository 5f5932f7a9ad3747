"""Metric queries."""

from ledgermill.catalog.prelude import TODAY
from ledgermill.catalog.registry import query
from ledgermill.metrics import MetricStore
from ledgermill.sources.testbed import AS_OF


class MartFrames(dict):
    """The mart frames, each built when a query first asks for it."""

    def __init__(self, testbed):
        super().__init__()
        self.testbed = testbed

    def __missing__(self, name):
        return getattr(self.testbed, "thresholds" if name == "audit_materiality" else name)


def store(t) -> MetricStore:
    return MetricStore(MartFrames(t), as_of=AS_OF)


def total(expr: str) -> str:
    return f"cast(sum(cast({expr} as decimal(18,2))) as double)"


def month(expr: str) -> str:
    return f"cast(date_trunc('month', {expr}) as date)"


def metric_query(name, sql, metrics, group_by=(), where=None):
    query(name, sql)(lambda t: store(t).query(list(metrics), list(group_by), where))


REVENUE_MONTHS = f"""
    select {month("created_at")} as metric_time__month,
        {total("recognized_revenue")} as total_recognized_revenue,
        {total("gross_revenue")} as total_gross_revenue,
        count(distinct order_id) as order_count
    from revenue group by 1"""

REFUND_MONTHS = f"""
    select {month("order_date")} as metric_time__month,
        {total("refund_amount")} as total_refund_amount,
        {total("net_revenue")} as total_net_revenue,
        {total("gross_revenue")} as refund_base_gross_revenue
    from refund_reconciliation group by 1"""

metric_query(
    "m01_semantic_dimensions",
    f"""select gross_revenue > 200 is true as order__is_high_value_order,
        cutoff_status as order__cutoff_status, count(distinct order_id) as order_count,
        {total("gross_revenue")} as total_gross_revenue
    from revenue group by 1, 2""",
    ["order_count", "total_gross_revenue"],
    ["order__is_high_value_order", "order__cutoff_status"],
)
metric_query(
    "m02_entities",
    f"select user_id as order__user, {total('gross_revenue')} as total_gross_revenue "
    f"from revenue group by 1",
    ["total_gross_revenue"],
    ["order__user"],
)
metric_query(
    "m03_time_dimensions",
    f"""select cast(date_trunc('quarter', shipped_at) as date) as order__shipped_at__quarter,
        order_status as order__order_status,
        {total("recognized_revenue")} as total_recognized_revenue
    from revenue group by 1, 2""",
    ["total_recognized_revenue"],
    ["order__shipped_at__quarter", "order__order_status"],
)
metric_query(
    "m04_measures",
    f"""select order_item_status as order_item__order_item_status,
        {total("sale_price")} as total_item_gross_revenue,
        {total("recognized_item_revenue")} as total_recognized_item_revenue,
        count(distinct order_item_id) as item_count
    from order_item_revenue group by 1""",
    ["total_item_gross_revenue", "total_recognized_item_revenue", "item_count"],
    ["order_item__order_item_status"],
)
metric_query(
    "m05_simple_revenue",
    REVENUE_MONTHS,
    ["total_recognized_revenue", "total_gross_revenue", "order_count"],
    ["metric_time__month"],
)
metric_query(
    "m05_simple_refunds",
    REFUND_MONTHS,
    ["total_refund_amount", "total_net_revenue", "refund_base_gross_revenue"],
    ["metric_time__month"],
)
metric_query(
    "m05_simple_items",
    f"""select cast(date_trunc('day', created_at) as date) as metric_time__day,
        {total("sale_price")} as total_item_gross_revenue,
        {total("recognized_item_revenue")} as total_recognized_item_revenue,
        count(distinct order_item_id) as item_count
    from order_item_revenue group by 1""",
    ["total_item_gross_revenue", "total_recognized_item_revenue", "item_count"],
    ["metric_time__day"],
)
metric_query(
    "m05_simple_inventory",
    f"""select cast(fiscal_year as varchar) as product__fiscal_year,
        product_category as product__product_category,
        {total("ending_gross_inv_value")} as total_inventory_value,
        {total("ending_net_realizable_value")} as total_net_realizable_value,
        {total("ending_allowance_lcm")} as total_lcm_allowance,
        {total("period_cogs_amount")} as total_cogs,
        {total("period_revenue")} as total_period_revenue
    from inventory_fiscal_report group by 1, 2""",
    [
        "total_inventory_value",
        "total_net_realizable_value",
        "total_lcm_allowance",
        "total_cogs",
        "total_period_revenue",
    ],
    ["product__fiscal_year", "product__product_category"],
)
metric_query(
    "m05_inventory_by_year_end",
    f"""select cast(date_trunc('year', least(make_date(fiscal_year, 12, 31), {TODAY})) as date)
            as metric_time__year, {total("period_cogs_amount")} as total_cogs
    from inventory_fiscal_report group by 1""",
    ["total_cogs"],
    ["metric_time__year"],
)
metric_query(
    "m06_ratio_recognition_rate",
    f"""select {month("created_at")} as metric_time__month,
        {total("recognized_revenue")} / nullif({total("gross_revenue")}, 0)
            as revenue_recognition_rate
    from revenue group by 1""",
    ["revenue_recognition_rate"],
    ["metric_time__month"],
)
metric_query(
    "m06_ratio_refund_rate",
    f"""select refund_type as order__refund_type,
        {total("refund_amount")} / nullif({total("gross_revenue")}, 0) as refund_rate,
        {total("refund_amount")} as total_refund_amount, {total("net_revenue")}
            as total_net_revenue
    from refund_reconciliation group by 1""",
    ["refund_rate", "total_refund_amount", "total_net_revenue"],
    ["order__refund_type"],
)
metric_query(
    "m06_ratio_item_recognition_rate",
    f"""select order_item_status as order_item__order_item_status,
        {total("recognized_item_revenue")} / nullif({total("sale_price")}, 0)
            as item_recognition_rate
    from order_item_revenue group by 1""",
    ["item_recognition_rate"],
    ["order_item__order_item_status"],
)

SPINE = """
    , spine as (
        select cast(unnest(generate_series(date_trunc('month', min({time})),
            date_trunc('month', max({time})), interval 1 month)) as date) as period
        from {source})"""

metric_query(
    "m07_cumulative_revenue",
    SPINE.format(time="created_at", source="revenue")
    + f"""
    select period as metric_time__month,
        {total("recognized_revenue")} as cumulative_recognized_revenue,
        {total("gross_revenue")} as cumulative_gross_revenue,
        count(distinct order_id) as cumulative_order_count
    from spine join revenue on {month("created_at")} <= period group by 1""",
    ["cumulative_recognized_revenue", "cumulative_gross_revenue", "cumulative_order_count"],
    ["metric_time__month"],
)
metric_query(
    "m07_cumulative_refunds",
    SPINE.format(time="order_date", source="refund_reconciliation")
    + f"""
    select period as metric_time__month, refund_type as order__refund_type,
        {total("refund_amount")} as cumulative_refund_amount
    from spine join refund_reconciliation on {month("order_date")} <= period group by 1, 2""",
    ["cumulative_refund_amount"],
    ["metric_time__month", "order__refund_type"],
)
metric_query(
    "m07_cumulative_daily",
    """
    , daily as (
        select cast(created_at as date) as day, order_status, count(distinct order_id) as orders
        from revenue where created_at is not null group by 1, 2),
    statuses as (select order_status, min(day) as first_day from daily group by 1),
    spine as (
        select order_status, cast(unnest(generate_series(first_day,
            (select max(day) from daily), interval 1 day)) as date) as day from statuses)
    select s.day as metric_time__day, s.order_status as order__order_status,
        cast(sum(coalesce(orders, 0)) over (partition by s.order_status order by s.day
            rows unbounded preceding) as bigint) as cumulative_order_count
    from spine s left join daily d on d.day = s.day and d.order_status = s.order_status""",
    ["cumulative_order_count"],
    ["metric_time__day", "order__order_status"],
)


def growth_sql(metric: str, value: str, time: str, source: str) -> str:
    return f"""
    , monthly as (select {month(time)} as period, {value} as v from {source} group by 1),
    later as (select cast(period + interval 1 month as date) as period, v from monthly
              where period is not null)
    select coalesce(m.period, l.period) as metric_time__month,
        (m.v - l.v) * 100 / nullif(l.v, 0) as {metric}
    from monthly m full join later l on l.period = m.period"""


for _metric, _value, _time, _source in (
    ("revenue_growth_mom", total("recognized_revenue"), "created_at", "revenue"),
    ("gross_revenue_growth_mom", total("gross_revenue"), "created_at", "revenue"),
    (
        "item_revenue_growth_mom",
        total("recognized_item_revenue"),
        "created_at",
        "order_item_revenue",
    ),
):
    metric_query(
        f"m08_{_metric}",
        growth_sql(_metric, _value, _time, _source),
        [_metric],
        ["metric_time__month"],
    )

metric_query(
    "m08_refund_rate_change_mom",
    f"""
    , monthly as (
        select {month("order_date")} as period,
            {total("refund_amount")} / nullif({total("gross_revenue")}, 0) as rate
        from refund_reconciliation group by 1)
    select coalesce(m.period, l.period) as metric_time__month,
        m.rate - l.rate as refund_rate_change_mom
    from monthly m full join (
        select cast(period + interval 1 month as date) as period, rate from monthly
    ) l on l.period = m.period""",
    ["refund_rate_change_mom"],
    ["metric_time__month"],
)
metric_query(
    "m08_inventory_gross_profit",
    f"""select cast(fiscal_year as varchar) as product__fiscal_year,
        {total("period_revenue")} - {total("period_cogs_amount")} as inventory_gross_profit
    from inventory_fiscal_report group by 1""",
    ["inventory_gross_profit"],
    ["product__fiscal_year"],
)
metric_query(
    "m09_year_to_date",
    f"""
    , chosen as (
        select * from revenue where created_at >= date '1998-01-01'
            and created_at < date '1999-01-01')"""
    + SPINE.format(time="created_at", source="chosen")
    + f"""
    select period as metric_time__month,
        {total("recognized_revenue")} as cumulative_recognized_revenue
    from spine join chosen on {month("created_at")} <= period group by 1""",
    ["cumulative_recognized_revenue"],
    ["metric_time__month"],
    "metric_time__day >= '1998-01-01' and metric_time__day < '1999-01-01'",
)
metric_query(
    "m09_growth_within_year",
    growth_sql("revenue_growth_mom", total("recognized_revenue"), "created_at",
               "(select * from revenue where cutoff_status <> 'NORMAL')")
    .replace("select coalesce(m.period", "select * from (select coalesce(m.period")
    + ") where metric_time__month between date '1998-01-01' and date '1998-12-31'",
    ["revenue_growth_mom"],
    ["metric_time__month"],
    [
        "metric_time__month >= '1998-01-01'",
        "metric_time__month < '1999-01-01'",
        "order__cutoff_status <> 'NORMAL'",
    ],
)
metric_query(
    "m10_revenue_and_refunds",
    f"""
    , a as ({REVENUE_MONTHS}), b as ({REFUND_MONTHS})
    select coalesce(a.metric_time__month, b.metric_time__month) as metric_time__month,
        total_recognized_revenue, order_count, total_refund_amount,
        total_refund_amount / nullif(refund_base_gross_revenue, 0) as refund_rate
    from a full join b on a.metric_time__month is not distinct from b.metric_time__month""",
    ["total_recognized_revenue", "order_count", "total_refund_amount", "refund_rate"],
    ["metric_time__month"],
)
metric_query(
    "m10_totals_across_models",
    f"""select {total("gross_revenue")} as total_gross_revenue,
        count(distinct order_id) as order_count,
        (select {total("refund_amount")} from refund_reconciliation) as total_refund_amount,
        (select count(distinct order_item_id) from order_item_revenue) as item_count
    from revenue""",
    ["total_gross_revenue", "order_count", "total_refund_amount", "item_count"],
)
metric_query(
    "j11_entity_join_orders",
    f"""select cutoff_status as order__cutoff_status,
        order_item_status as order_item__order_item_status,
        {total("sale_price")} as total_item_gross_revenue
    from order_item_revenue i left join revenue r on r.order_id = i.order_id group by 1, 2""",
    ["total_item_gross_revenue"],
    ["order__cutoff_status", "order_item__order_item_status"],
)
metric_query(
    "j11_entity_join_risk_tier",
    f"""select cast(fiscal_year as varchar) as product__fiscal_year,
        t.risk_tier as product_category__risk_tier,
        {total("ending_allowance_lcm")} as total_lcm_allowance
    from inventory_fiscal_report r
    left join thresholds t on t.product_category = r.product_category group by 1, 2""",
    ["total_lcm_allowance"],
    ["product__fiscal_year", "product_category__risk_tier"],
)
metric_query(
    "j12_spine_join",
    SPINE.format(time="created_at", source="revenue").replace("'month'", "'quarter'").replace(
        "interval 1 month", "interval 3 month"
    )
    + f"""
    select period as metric_time__quarter, cutoff_status as order__cutoff_status,
        {total("gross_revenue")} as cumulative_gross_revenue
    from spine join revenue on cast(date_trunc('quarter', created_at) as date) <= period
    group by 1, 2""",
    ["cumulative_gross_revenue"],
    ["metric_time__quarter", "order__cutoff_status"],
)

metric_query(
    "m09_growth_of_some_orders",
    f"""
    , monthly as (select {month("created_at")} as period, {total("recognized_revenue")} as v
        from revenue where cutoff_status <> 'PENDING' group by 1),
    later as (select cast(period + interval 1 month as date) as period, v from monthly
        where period is not null)
    select coalesce(m.period, l.period) as metric_time__month,
        (m.v - l.v) * 100 / nullif(l.v, 0) as revenue_growth_mom
    from monthly m full join later l on l.period = m.period
    where coalesce(m.period, l.period) between date '1996-02-01' and date '1997-06-01'""",
    ["revenue_growth_mom"],
    ["metric_time__month"],
    "metric_time__month between '1996-02-01' and '1997-06-01' "
    "and order__cutoff_status <> 'PENDING'",
)
metric_query(
    "f10_metric_time_range",
    f"""
    select {month("created_at")} as metric_time__month,
        {total("gross_revenue")} as total_gross_revenue
    from revenue where cast(created_at as date) between date '1996-01-10' and date '1996-08-20'
    group by 1""",
    ["total_gross_revenue"],
    ["metric_time__month"],
    "metric_time__day between '1996-01-10' and '1996-08-20'",
)
