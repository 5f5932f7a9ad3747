"""Constraints: violating rows one by one, and the whole suite."""


from ledgermill.catalog.registry import query
from ledgermill.operators import quality as q
from ledgermill.plans.constraints import declared_constraints

# Frame of each constrained table, and its model in the reference SQL.
FRAMES = {
    "raw_orders": (lambda t: t.raw("raw_orders"), "raw_orders"),
    "raw_order_items": (lambda t: t.raw("raw_order_items"), "raw_order_items"),
    "raw_products": (lambda t: t.raw("raw_products"), "raw_products"),
    "raw_users": (lambda t: t.raw("raw_users"), "raw_users"),
    "raw_inventory_items": (lambda t: t.raw("raw_inventory_items"), "raw_inventory_items"),
    "staged_inventory_items": (
        lambda t: t.staged("raw_inventory_items"), "stg_raw_inventory_items",
    ),
    "staged_order_items": (lambda t: t.staged("raw_order_items"), "stg_raw_order_items"),
    "staged_orders": (lambda t: t.staged("raw_orders"), "stg_raw_orders"),
    "staged_products": (lambda t: t.products, "products"),
    "staged_users": (lambda t: t.users, "users"),
    "staged_incremental_order_items": (
        lambda t: t.staged("incr_order_items"), "stg_incr_order_items",
    ),
    "staged_incremental_orders": (lambda t: t.staged("incr_orders"), "stg_incr_orders"),
    "staged_incremental_inventory_items": (
        lambda t: t.staged("incr_inventory_items"), "stg_incr_inventory_items",
    ),
    "thresholds": (lambda t: t.thresholds, "thresholds"),
    "order_items": (lambda t: t.order_items, "order_items"),
    "aggregated": (lambda t: t.aggregated, "aggregated"),
    "joined": (lambda t: t.joined, "joined"),
    "inventory_items": (lambda t: t.inventory_items, "inventory_items"),
    "lifecycle": (lambda t: t.lifecycle, "lifecycle"),
    "inventory_fiscal_report": (lambda t: t.inventory_fiscal_report, "inventory_fiscal_report"),
    "order_reconciliation": (lambda t: t.order_reconciliation, "order_reconciliation"),
    "refund_reconciliation": (lambda t: t.refund_reconciliation, "refund_reconciliation"),
    "order_item_revenue": (lambda t: t.order_item_revenue, "order_item_revenue"),
    "inventory_sellthrough": (lambda t: t.inventory_sellthrough, "inventory_sellthrough"),
    "revenue": (lambda t: t.revenue, "revenue"),
}


def _literal(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _failures_sql(rule: q.Constraint) -> str:
    """Number of violations of a constraint, as SQL."""
    model = FRAMES[rule.table][1]
    if isinstance(rule, q.Unique):
        keys = ", ".join(rule.columns)
        known = " and ".join(f"{c} is not null" for c in rule.columns)
        where = f" where {known}" if rule.ignore_null else ""
        return (
            f"select count(*) from (select {keys} from {model}{where} "
            f"group by {keys} having count(*) > 1)"
        )
    if isinstance(rule, q.Relationship):
        parent = FRAMES[rule.to][1]
        return (
            f"select count(*) from {model} where {rule.column} is not null "
            f"and {rule.column} not in (select {rule.field} from {parent})"
        )
    if isinstance(rule, q.NotNull):
        broken = f"{rule.column} is null"
    elif isinstance(rule, q.AcceptedValues):
        broken = f"{rule.column} not in ({', '.join(map(_literal, rule.values))})"
    elif isinstance(rule, q.ExpressionIsTrue):
        broken = f"not ({rule.condition})"
    elif isinstance(rule, q.AcceptedRange):
        broken = f"{rule.column} not between {rule.low} and {rule.high}"
    else:
        broken = f"{rule.column} > {rule.other}"
    where = f"({rule.where}) and {broken}" if rule.where else broken
    return f"select count(*) from {model} where {where}"


def _suite_sql() -> str:
    rows = []
    for rule in declared_constraints():
        name = rule.name if rule.where is None else f"{rule.name} where {rule.where}"
        rows.append(
            f"select {_literal(rule.table)} as table_name, {_literal(name)} as test_name, "
            f"'{rule.severity}' as severity, ({_failures_sql(rule)}) as failures"
        )
    return (
        "select *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' "
        f"else 'fail' end as status from ({' union all '.join(rows)})"
    )


@query(
    "q01_unique",
    "select user_id, count(*) as n_records from ledger_orders group by 1 having count(*) > 1",
)
def _(t):
    return q.Unique("orders", columns=("user_id",)).violations(t.orders)


@query(
    "q02_not_null",
    "select inventory_item_id, product_id, created_at from inventory_items "
    "where product_category = 'socks' and sold_at is null",
)
def _(t):
    rule = q.NotNull("inventory_items", where="product_category = 'socks'", column="sold_at")
    return rule.violations(t.inventory_items).select(
        "inventory_item_id", "product_id", "created_at"
    )


@query(
    "q03_accepted_values",
    "select order_id, order_item_status_list from aggregated "
    "where order_item_status_list not in ('complete', 'returned', 'shipped')",
)
def _(t):
    rule = q.AcceptedValues(
        "aggregated", column="order_item_status_list", values=("complete", "returned", "shipped")
    )
    return rule.violations(t.aggregated).select("order_id", "order_item_status_list")


@query(
    "q04_relationships",
    "select id, order_id from raw_order_items "
    "where order_id not in (select order_id from raw_orders)",
)
def _(t):
    rule = q.Relationship("raw_order_items", column="order_id", to="raw_orders", field="order_id")
    return rule.violations(t.raw("raw_order_items"), t.raw("raw_orders")).select("id", "order_id")


@query(
    "q05_expression_is_true",
    "select inventory_item_id, lcm_unit_valuation, current_market_price from lifecycle "
    "where not (lcm_unit_valuation >= current_market_price)",
)
def _(t):
    rule = q.ExpressionIsTrue(
        "lifecycle", column="lcm_unit_valuation", expression=">= current_market_price"
    )
    return rule.violations(t.lifecycle).select(
        "inventory_item_id", "lcm_unit_valuation", "current_market_price"
    )


@query(
    "q06_accepted_range",
    "select order_id, refund_value_rate from refund_reconciliation "
    "where refund_value_rate < 0 or refund_value_rate > 0.5",
)
def _(t):
    rule = q.AcceptedRange("refunds", column="refund_value_rate", low=0, high=0.5)
    return rule.violations(t.refund_reconciliation).select("order_id", "refund_value_rate")


@query(
    "q07_unique_combination",
    "select user_id, order_status, count(*) as n_records from ledger_orders "
    "group by 1, 2 having count(*) > 1",
)
def _(t):
    rule = q.Unique("orders", columns=("user_id", "order_status"), ignore_null=False)
    return rule.violations(t.orders)


@query(
    "q08_not_exceeding",
    "select order_id, created_at, shipped_at from ledger_orders where created_at > shipped_at",
)
def _(t):
    rule = q.NotExceeding("orders", column="created_at", other="shipped_at")
    return rule.violations(t.orders).select("order_id", "created_at", "shipped_at")


@query(
    "q09_severity",
    "select 'inventory_fiscal_report' as table_name, test_name, severity, failures, "
    "case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end "
    "as status from (select 'accepted_values(audit_check_diff)' as test_name, "
    "'warn' as severity, count(*) filter (where audit_check_diff <> 0) as failures "
    "from inventory_fiscal_report union all select 'accepted_values(inventory_risk_rating)', "
    "'error', count(*) filter (where inventory_risk_rating <> 'Healthy') "
    "from inventory_fiscal_report)",
)
def _(t):
    table = "inventory_fiscal_report"
    rules = [
        q.AcceptedValues(table, severity="warn", column="audit_check_diff", values=(0,)),
        q.AcceptedValues(table, column="inventory_risk_rating", values=("Healthy",)),
    ]
    return q.run_constraints({table: t.inventory_fiscal_report}, rules)


# Frames that several constrained tables derive from, each before those it leads to, and last
# the tables that need a shuffle of their own: the suite then holds none but that of its keys.
SHARED = (
    "headed_lines", "all_orders", "all_inventory_items", "aggregated", "joined", "lifecycle",
    "inventory_fiscal_report", "order_item_revenue",
)


@query("q10_suite", _suite_sql())
def _(t):
    t.keep(*SHARED)
    frames = {name: build(t) for name, (build, _) in FRAMES.items()}
    return q.run_constraints(frames, declared_constraints())
