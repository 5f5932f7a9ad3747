"""The daily run: freshness, snapshot, marts, constraints, export.

A plain function for any scheduler to call. Marts live under ``{root}/marts`` and the price
history under ``{root}/snapshots``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.calendar import AsOf
from ledgermill.operators import fiscal, inventory, orders
from ledgermill.operators.controls import run_controls, variances
from ledgermill.operators.freshness import freshness
from ledgermill.operators.merge import (
    current_path,
    merge_mart,
    month_period,
    prune_generations,
    read_mart,
    rebuild_mart,
)
from ledgermill.operators.orders import LOOKBACK_DAYS, Lookback
from ledgermill.operators.quality import run_constraints
from ledgermill.operators.scd2 import PRICE_CHECK_COLUMNS, PRICE_KEY, read_history, save_snapshot
from ledgermill.plans.constraints import declared_constraints
from ledgermill.session import configure, staged
from ledgermill.sources import seeds, tables
from ledgermill.sources.staging import price_snapshot_input, stage

SUNDAY = 6
PRICE_HISTORY = "snapshots/price_history"
FRESHNESS_SOURCES = ("incr_orders", "incr_order_items")

# mart -> the times its files are laid out by
LAYOUT: dict[str, tuple[str, ...]] = {
    "revenue": ("created_at", "shipped_at"),
    "order_item_revenue": ("created_at", "shipped_at", "returned_at"),
}

# mart -> key and time column of its periods; both None when always rebuilt
MARTS: dict[str, tuple[str | None, str | None]] = {
    "order_reconciliation": ("order_id", "order_at"),
    "revenue": ("order_id", "created_at"),
    "refund_reconciliation": ("order_id", "order_date"),
    "order_item_revenue": ("order_item_id", "created_at"),
    "inventory_fiscal_report": (None, None),
    "inventory_sellthrough": (None, None),
}


@dataclass(frozen=True)
class DailyResult:
    freshness: DataFrame
    constraints: DataFrame
    controls: DataFrame
    marts: dict[str, DataFrame]

    def blocking(self) -> list[str]:
        """What must keep the marts from being exported: failed tests, stale sources."""
        failed = self.constraints.unionByName(self.controls).filter("status = 'fail'")
        stale = self.freshness.filter("status = 'error'")
        return [
            *(f"{r.table_name}: {r.test_name} ({r.failures})" for r in failed.collect()),
            *(f"{r.source}: not fresh" for r in stale.collect()),
        ]


class ExportBlocked(RuntimeError):
    """Tests failed or sources are stale; ``result`` holds the run, nothing was exported."""

    def __init__(self, result: DailyResult, reasons: list[str]):
        super().__init__("; ".join(reasons))
        self.result = result


def is_full_refresh_day(as_of: datetime) -> bool:
    """Sundays rebuild everything, to catch corrections older than the look-back window."""
    return as_of.weekday() == SUNDAY


def lookback_for(
    as_of: datetime, full_refresh: bool | None = None, days: int = LOOKBACK_DAYS
) -> Lookback | None:
    """The window of an incremental run, None for a full one; Sundays decide by default."""
    whole = is_full_refresh_day(as_of) if full_refresh is None else full_refresh
    return None if whole else Lookback(as_of, days)


def refresh_mart(
    spark: SparkSession, root: str, name: str, rows: DataFrame, lookback: Lookback | None
) -> DataFrame:
    """Merge the rows of a window into a mart, or rebuild it without one; gives the mart."""
    path, (key, time) = f"{root}/marts/{name}", MARTS[name]
    period, layout = None if time is None else month_period(time), LAYOUT.get(name, ())
    if lookback is None or key is None:
        rebuild_mart(rows, path, period, layout)
    else:
        merge_mart(spark, path, rows, key, period, layout)
    return read_mart(spark, path, rows.schema)


def staged_sources(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage(name, df) for name, df in raw.items()}


def _both(sources: dict[str, DataFrame], table: str) -> DataFrame:
    return sources[f"raw_{table}"].unionByName(sources[f"incr_{table}"])


def check_freshness(raw: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    first, second = (
        freshness(raw[name], as_of=as_of).select(F.lit(name).alias("source"), "*")
        for name in FRESHNESS_SOURCES
    )
    return first.unionByName(second)


def take_snapshot(
    spark: SparkSession, raw_products: DataFrame, root: str, as_of: AsOf
) -> DataFrame:
    """Refresh the price history and return it."""
    path = f"{root}/{PRICE_HISTORY}"
    current = price_snapshot_input(raw_products)
    save_snapshot(spark, path, current, PRICE_KEY, PRICE_CHECK_COLUMNS, as_of)
    return read_history(spark, path)


def order_ledgers(
    sources: dict[str, DataFrame], lookback: Lookback | None = None
) -> tuple[DataFrame, DataFrame]:
    """Sub-ledger and joined ledgers, whole or for the orders a look-back window touches.

    Each is written once, since several marts and constraints read it.
    """
    headers, lines = _both(sources, "orders"), _both(sources, "order_items")
    if lookback is not None:
        headers, lines = orders.touched_ledgers(headers, lines, lookback)
    aggregated = staged(orders.aggregate_order_items(lines), "aggregated")
    return aggregated, staged(orders.join_master_subledger(headers, aggregated), "joined")


def suspect_subledger(sources: dict[str, DataFrame], reconciliation: DataFrame) -> DataFrame:
    """Sub-ledger of the orders with a variance, as the controls need it.

    All lines are scanned for them, of any age, but only the lines of those orders are
    aggregated.
    """
    suspects = variances(reconciliation).select("order_id").distinct()
    lines = _both(sources, "order_items").join(suspects, "order_id", "left_semi")
    return orders.aggregate_order_items(lines)


def order_marts(
    sources: dict[str, DataFrame],
    aggregated: DataFrame,
    joined: DataFrame,
    lookback: Lookback | None,
) -> dict[str, DataFrame]:
    """The four order and item marts: whole, or the rows of the look-back window."""
    lines, products = _both(sources, "order_items"), sources["raw_products"]
    return {
        "order_reconciliation": orders.order_reconciliation(joined, lookback),
        "revenue": orders.revenue(joined, lookback),
        "refund_reconciliation": orders.refund_reconciliation(aggregated, lookback),
        "order_item_revenue": orders.order_item_revenue(lines, products, lookback),
    }


def inventory_marts(
    sources: dict[str, DataFrame],
    lifecycle: DataFrame,
    history: DataFrame,
    thresholds: DataFrame,
    as_of: AsOf,
) -> dict[str, DataFrame]:
    """The two inventory marts, always whole: balances carry over from year to year."""
    return {
        "inventory_fiscal_report": fiscal.inventory_fiscal_report(
            lifecycle, history, thresholds, as_of
        ),
        "inventory_sellthrough": inventory.inventory_sellthrough(_both(sources, "inventory_items")),
    }


def source_tables(
    raw: dict[str, DataFrame], sources: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Raw, staged and united tables under the names the constraints use."""
    tested = {name: df for name, df in raw.items() if name.startswith("raw_")}
    for name, df in sources.items():
        origin, table = name.split("_", 1)
        tested[f"staged_{table}" if origin == "raw" else f"staged_incremental_{table}"] = df
    united = {table: _both(sources, table) for table in ("order_items", "inventory_items")}
    return tested | united


def run(
    spark: SparkSession,
    sources_root: str,
    root: str,
    as_of: datetime,
    full_refresh: bool | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    seed_path: str | None = None,
    export_dir: str | None = None,
    force: bool = False,
    keep_generations: int | None = None,
) -> DailyResult:
    """Bring all marts up to date and test them.

    Without an explicit choice, Sundays rebuild the incremental marts and other days merge
    the look-back window into them. Constraints and the four business controls run on what
    is there afterwards: on all sources and marts, and on the two order ledgers as far as the
    run built them, which on a day of merging means the orders its window touches. A failed one of error severity, or a source past its error age, keeps
    the marts from being exported (``ExportBlocked``) unless ``force`` is set.

    ``keep_generations`` deletes older copies of each mart at the end; by default all stay.
    """
    configure(spark)
    raw = tables.load_all(spark, sources_root)
    sources = staged_sources(raw)
    thresholds = seeds.thresholds(spark, seed_path)
    fresh = check_freshness(raw, as_of)
    history = take_snapshot(spark, raw["raw_products"], root, as_of)

    kept = [f"{root}/marts/{name}" for name, (key, _) in MARTS.items() if key]
    first_run = any(current_path(spark, path) is None for path in kept)
    lookback = lookback_for(as_of, True if first_run else full_refresh, lookback_days)
    aggregated, joined = order_ledgers(sources, lookback)
    lifecycle = staged(
        inventory.inventory_lifecycle(
            _both(sources, "inventory_items"), _both(sources, "order_items"), as_of
        ),
        "lifecycle",
    )
    built = order_marts(sources, aggregated, joined, lookback)
    built |= inventory_marts(sources, lifecycle, history, thresholds, as_of)
    marts = {name: refresh_mart(spark, root, name, built[name], lookback) for name in MARTS}

    models = {"aggregated": aggregated, "joined": joined, "lifecycle": lifecycle}
    tested = source_tables(raw, sources) | models | marts | {"thresholds": thresholds}
    results = staged(run_constraints(tested, declared_constraints()), "constraint-results")
    reconciliation = marts["order_reconciliation"]
    subledger = aggregated if lookback is None else suspect_subledger(sources, reconciliation)
    controls = run_controls(
        reconciliation, subledger, marts["revenue"], marts["order_item_revenue"]
    )
    result = DailyResult(fresh, results, staged(controls, "control-results"), marts)
    if export_dir is not None:
        if not force and (reasons := result.blocking()):
            raise ExportBlocked(result, reasons)
        tables.export_csv(marts, export_dir)
    if keep_generations is not None:
        for name in MARTS:
            prune_generations(spark, f"{root}/marts/{name}", keep_generations)
    return result
