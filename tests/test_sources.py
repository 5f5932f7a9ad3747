from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import AnalysisException

from ledgermill.operators.subset import sample_products, snowball_subset
from ledgermill.session import stage_path, stage_root
from ledgermill.sources import seeds, tables
from ledgermill.sources.spine import time_spine
from tests.conftest import rows


def test_stage_folder_is_the_one_the_session_names(spark):
    assert stage_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_missing_tables(spark):
    root = stage_path(spark, "nothing")
    assert tables.load(spark, root, "incr_orders").count() == 0
    with pytest.raises(AnalysisException):
        tables.load(spark, root, "raw_orders").count()


def test_an_empty_frame_leaves_the_sink_untouched(spark, frame):
    path = stage_path(spark, "sink")
    assert tables.write_parquet(frame("a long", (1,)), path)
    assert not tables.write_parquet(frame("a long"), path)
    assert rows(spark.read.parquet(path)) == [(1,)]


def test_append_adds_files_without_reading_old_ones(spark, frame):
    path = stage_path(spark, "sink")
    tables.append_parquet(frame("a long", (1,)), path)
    first = set(spark.read.parquet(path).inputFiles())
    tables.append_parquet(frame("a long", (2,)), path)
    assert first < set(spark.read.parquet(path).inputFiles())
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]


def test_csv_export_has_a_header(spark, frame):
    out = stage_path(spark, "export")
    tables.export_csv({"m": frame("a long, b string", (1, "x,y"))}, out)
    assert rows(spark.read.csv(f"{out}/m", header=True)) == [("1", "x,y")]


def test_materialize(spark, frame):
    df = frame("a long", (1,))
    assert rows(tables.materialize(df, "as_view", "view")) == [(1,)]
    assert rows(tables.materialize(df, "as_table", "table", stage_path(spark, "t"))) == [(1,)]
    with pytest.raises(ValueError):
        tables.materialize(df, "x", "magic")


def test_thresholds_from_package_and_from_a_file(spark):
    shipped = seeds.thresholds(spark)
    assert shipped.count() == 26
    tiers = shipped.groupBy("risk_tier").count()
    assert rows(tiers) == [("High", 4), ("Low", 9), ("Medium", 13)]
    out = stage_path(spark, "seed")
    tables.export_csv({"seed": shipped}, out)
    assert rows(seeds.thresholds(spark, f"{out}/seed")) == rows(shipped)


def test_time_spine_excludes_its_end(spark):
    spine = time_spine(spark, as_of="2024-06-30 00:00:00")
    bounds = spine.selectExpr("min(date_day)", "max(date_day)", "count(*)").first()
    assert bounds[:2] == (date(2019, 1, 1), date(2026, 12, 31))
    assert bounds[2] == (date(2027, 1, 1) - date(2019, 1, 1)).days


def test_subset_is_closed_and_repeatable(testbed):
    names = ("orders", "order_items", "inventory_items", "users", "products")
    raw = {f"raw_{n}": testbed.raw(f"raw_{n}") for n in names}
    subset = snowball_subset(raw, 3, "x")
    assert rows(sample_products(raw["raw_order_items"], 3, "x")) == rows(
        sample_products(raw["raw_order_items"].repartition(7), 3, "x")
    )
    assert 0 < subset["raw_orders"].count() < raw["raw_orders"].count()
    items = subset["raw_order_items"]
    for child, key, parent, field in (
        (items, "order_id", "raw_orders", "order_id"),
        (items, "product_id", "raw_products", "id"),
        (subset["raw_orders"], "user_id", "raw_users", "id"),
        (subset["raw_inventory_items"], "product_id", "raw_products", "id"),
    ):
        keys = subset[parent].select(subset[parent][field].alias(key))
        assert child.join(keys, key, "left_anti").count() == 0


def test_clearing_removes_only_what_this_application_staged(spark, frame, monkeypatch):
    from ledgermill import session

    mine, other = (f"{stage_root(spark)}/ledgermill-{name}" for name in ("mine", "other"))
    monkeypatch.setattr(session, "application_folder", lambda _: mine)
    frame("a long", (1,)).write.parquet(other)
    assert rows(session.staged(frame("a long", (2,)), "t")) == [(2,)]
    session.clear_stages(spark)
    assert not tables.path_exists(spark, mine)
    assert tables.path_exists(spark, other)


def test_daily_batches_read_one_extract(testbed, monkeypatch):
    """The extract is derived once, not again for each batch and for the layout's sample."""
    from ledgermill.catalog import ingest

    plans, append = [], tables.append_parquet

    def noted(df, path, cluster_by=()):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        append(df, path, cluster_by=cluster_by)

    monkeypatch.setattr(ingest.tables, "append_parquet", noted)
    found = ingest._appended_daily("incr_order_items")(testbed)
    assert found.count() == testbed.extracted("incr_order_items").count()
    assert len(plans) == 2 and not any("Join" in plan for plan in plans)
