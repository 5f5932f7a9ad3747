from __future__ import annotations

import glob
import os

import pytest
from pyspark.errors import PySparkException

from ledgermill.operators import merge, scd2
from ledgermill.operators.freshness import freshness
from ledgermill.session import stage_path
from tests.conftest import rows

MART = "id string, amount double, at timestamp"
FEB, MAR = "2024-02-10 00:00:00", "2024-03-10 00:00:00"


def test_upsert_replaces_adds_and_keeps(frame):
    target = frame(MART, ("a", 1.0, FEB), ("b", 2.0, FEB))
    updates = frame(MART, ("b", 3.0, FEB), ("c", 4.0, MAR))
    assert rows(merge.upsert(target, updates, "id"), "id", "amount") == [
        ("a", 1.0), ("b", 3.0), ("c", 4.0),
    ]


def test_upsert_rejects_duplicate_keys(frame):
    target = frame(MART, ("a", 1.0, FEB))
    updates = frame(MART, ("b", 3.0, FEB), ("b", 4.0, FEB))
    with pytest.raises(PySparkException, match="duplicate id"):
        merge.upsert(target, updates, "id").collect()


def test_upsert_twice_changes_nothing(frame):
    target, updates = frame(MART, ("a", 1.0, FEB)), frame(MART, ("a", 2.0, FEB))
    once = merge.upsert(target, updates, "id")
    assert rows(merge.upsert(once, updates, "id")) == rows(once)


def test_schema_sync_adds_and_drops(frame):
    target = frame("id string, gone string", ("a", "x"))
    updates = frame("id string, fresh long", ("b", 1))
    assert rows(merge.upsert(target, updates, "id")) == [("a", None), ("b", 1)]


def period():
    return merge.month_period("at")


def test_first_batch_is_written_once(spark, frame, monkeypatch):
    staged, write = [], merge.staged
    monkeypatch.setattr(merge, "staged", lambda df, label: staged.append(label) or write(df, label))
    path = stage_path(spark, "mart")
    twice = frame(MART, ("a", 2.0, FEB), ("a", 3.0, MAR))
    with pytest.raises(ValueError, match="duplicate id"):
        merge.merge_mart(spark, path, twice, "id", period())
    assert merge.current_path(spark, path) is None
    merge.merge_mart(spark, path, frame(MART, ("b", 1.0, MAR), (None, 2.0, None)), "id", period())
    assert staged == []
    assert rows(merge.read_mart(spark, path), "id", "amount") == [("b", 1.0), (None, 2.0)]


def test_merge_rewrites_only_touched_periods(spark, frame):
    path = stage_path(spark, "mart")
    merge.rebuild_mart(frame(MART, ("a", 1.0, FEB), ("b", 2.0, MAR), ("n", 9.0, None)), path,
                       period())
    folder = merge.current_path(spark, path)
    before = set(spark.read.parquet(f"{folder}/mart_period=2024-02").inputFiles())
    merge.merge_mart(spark, path, frame(MART, ("b", 5.0, MAR), ("c", 6.0, MAR)), "id", period())
    assert rows(merge.read_mart(spark, path), "id", "amount") == [
        ("a", 1.0), ("b", 5.0), ("c", 6.0), ("n", 9.0),
    ]
    assert set(spark.read.parquet(f"{folder}/mart_period=2024-02").inputFiles()) == before


def test_merge_moves_a_key_to_another_period(spark, frame):
    path = stage_path(spark, "mart")
    merge.rebuild_mart(frame(MART, ("a", 1.0, FEB), ("b", 2.0, MAR), ("n", 9.0, None)), path,
                       period())
    merge.merge_mart(spark, path, frame(MART, ("a", 7.0, MAR), ("n", 8.0, FEB)), "id", period())
    assert rows(merge.read_mart(spark, path), "id", "amount") == [
        ("a", 7.0), ("b", 2.0), ("n", 8.0),
    ]


def test_merge_twice_and_first_merge(spark, frame):
    path = stage_path(spark, "mart")
    batch = frame(MART, ("a", 1.0, FEB), ("b", 2.0, MAR))
    merge.merge_mart(spark, path, batch, "id", period())
    merge.merge_mart(spark, path, batch, "id", period())
    assert rows(merge.read_mart(spark, path)) == rows(batch)


def test_merge_rejects_duplicates_and_leaves_the_mart(spark, frame):
    path = stage_path(spark, "mart")
    merge.merge_mart(spark, path, frame(MART, ("a", 1.0, FEB)), "id", period())
    with pytest.raises(ValueError, match="duplicate id"):
        merge.merge_mart(spark, path, frame(MART, ("a", 2.0, FEB), ("a", 3.0, FEB)), "id",
                         period())
    assert rows(merge.read_mart(spark, path), "id", "amount") == [("a", 1.0)]


def test_merge_with_a_new_and_a_dropped_column(spark, frame):
    path = stage_path(spark, "mart")
    merge.rebuild_mart(frame(MART, ("a", 1.0, FEB), ("b", 2.0, MAR)), path, period())
    updates = frame("id string, at timestamp, note string", ("b", MAR, "new"))
    merge.merge_mart(spark, path, updates, "id", period())
    assert rows(merge.read_mart(spark, path, updates.schema), "id", "note") == [
        ("a", None), ("b", "new"),
    ]


def test_an_unfinished_rebuild_is_ignored(spark, frame):
    path = stage_path(spark, "mart")
    merge.rebuild_mart(frame(MART, ("a", 1.0, FEB)), path, period())
    unfinished, fs = merge._hadoop_path(spark, f"{path}/gen-00000002")
    fs.mkdirs(unfinished)
    assert rows(merge.read_mart(spark, path), "id") == [("a",)]


def test_a_merge_opens_only_its_periods(spark, frame):
    """All other periods, and after the first merge their keys, stay unread: here they are
    no Parquet files any more."""
    path = stage_path(spark, "mart")
    months = [f"2023-{m:02d}-05 00:00:00" for m in range(1, 13)]
    merge.rebuild_mart(frame(MART, *[(f"k{i}", float(i), at) for i, at in enumerate(months)]), path, period())
    merge.merge_mart(spark, path, frame(MART, ("k3", 33.0, months[3])), "id", period())
    folder = merge.current_path(spark, path)
    kept = {f"{folder}/mart_period=2023-{m}" for m in ("04", "06", "07")}
    spoiled = 0
    for m in range(1, 13):
        place = f"{folder}/mart_period=2023-{m:02d}"
        if place in kept:
            continue
        for file in glob.glob(f"{place}/*.parquet"):
            with open(file, "wb") as out:
                out.write(b"spoiled")
            spoiled += 1
    assert spoiled == 9
    merge.merge_mart(spark, path, frame(MART, ("k5", 55.0, months[6]), ("new", 1.0, months[3])), "id", period())
    schema = frame(MART).schema
    found = merge._read_periods(spark, folder, schema).filter("mart_period in ('2023-04', '2023-06', '2023-07')")
    assert rows(found, "id", "amount") == [("k3", 33.0), ("k5", 55.0), ("k6", 6.0), ("new", 1.0)]


def test_a_key_that_moves_twice_is_found(spark, frame):
    path = stage_path(spark, "mart")
    merge.rebuild_mart(frame(MART, ("a", 1.0, FEB), ("n", 0.0, None)), path, period())
    for amount, at in ((2.0, MAR), (3.0, None), (4.0, FEB), (5.0, MAR)):
        merge.merge_mart(spark, path, frame(MART, ("a", amount, at), (None, amount, at)), "id", period())
    found = rows(merge.read_mart(spark, path), "id", "amount")
    assert [r for r in found if r[0]] == [("a", 5.0), ("n", 0.0)]


def test_a_merge_cut_off_before_its_rows_is_repeated(spark, frame, monkeypatch):
    """The locator already lists the new place, the mart does not hold it yet."""
    path = stage_path(spark, "mart")
    merge.rebuild_mart(frame(MART, ("a", 1.0, FEB)), path, period())
    batch = frame(MART, ("a", 2.0, MAR))
    with monkeypatch.context() as patch:
        patch.setattr(merge, "_write_periods", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge.merge_mart(spark, path, batch, "id", period())
    merge.merge_mart(spark, path, batch, "id", period())
    merge.merge_mart(spark, path, frame(MART, ("a", 3.0, FEB)), "id", period())
    assert rows(merge.read_mart(spark, path), "id", "amount") == [("a", 3.0)]


def test_many_periods_are_joined(spark, frame, monkeypatch):
    monkeypatch.setattr(merge, "MOST_PERIODS", 1)
    path = stage_path(spark, "mart")
    merge.rebuild_mart(frame(MART, ("a", 1.0, FEB), ("b", 2.0, MAR)), path, period())
    merge.merge_mart(spark, path, frame(MART, ("a", 3.0, MAR), ("c", 4.0, None)), "id", period())
    assert rows(merge.read_mart(spark, path), "id", "amount") == [("a", 3.0), ("b", 2.0), ("c", 4.0)]


# price history

PRICES = "product_id string, cost double, retail_price double, category string, brand string, " \
    "product_name string"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def price(product, retail=10.0, brand="b", cost=5.0):
    return (product, cost, retail, "socks", brand, "name")


@pytest.fixture
def history(frame):
    def build(*snapshots):
        result = None
        for at, prices in snapshots:
            result = scd2.snapshot_prices(result, frame(PRICES, *prices), at)
        shown = rows(result, "product_id", "retail_price", "brand", "dbt_valid_from",
                     "dbt_valid_to")
        return [(p, r, b, str(f), t and str(t)) for p, r, b, f, t in shown]

    return build


def test_snapshot_inserts_and_repeats(history):
    once = [("a", 10.0, "b", T1, None)]
    assert history((T1, [price("a")])) == once
    assert history((T1, [price("a")]), (T1, [price("a")]), (T2, [price("a")])) == once


def test_tracked_change_opens_a_version(history):
    assert history((T1, [price("a")]), (T2, [price("a", 12.0)])) == [
        ("a", 10.0, "b", T1, T2), ("a", 12.0, "b", T2, None),
    ]


def test_null_is_a_value(history):
    assert len(history((T1, [price("a", None)]), (T2, [price("a", 1.0)]))) == 2
    assert len(history((T1, [price("a", None)]), (T2, [price("a", None)]))) == 1


def test_untracked_change_is_ignored(history):
    assert history((T1, [price("a")]), (T2, [price("a", brand="new")])) == [
        ("a", 10.0, "b", T1, None),
    ]


def test_delete_and_return(history):
    assert history((T1, [price("a"), price("z")]), (T2, [price("z")]),
                   (T3, [price("a"), price("z")])) == [
        ("a", 10.0, "b", T1, T2), ("a", 10.0, "b", T3, None), ("z", 10.0, "b", T1, None),
    ]


def test_deletes_may_be_left_open(frame):
    first = scd2.snapshot_prices(None, frame(PRICES, price("a")), T1)
    kept = scd2.scd2_snapshot(first, frame(PRICES), "product_id", ("cost",), T2, False)
    assert [r.dbt_valid_to for r in kept.collect()] == [None]


def test_versions_of_a_key_never_overlap(frame):
    history = None
    for day in range(1, 9):
        prices = [price(p, float(day * n % 3)) for n, p in enumerate("abcd", 1) if day % n != 1]
        history = scd2.snapshot_prices(history, frame(PRICES, *prices), f"2024-01-{day:02d}")
    spans = {}
    for row in history.collect():
        spans.setdefault(row.product_id, []).append((str(row.dbt_valid_from),
                                                     str(row.dbt_valid_to or "9")))
    for versions in spans.values():
        versions.sort()
        assert all(a[1] <= b[0] for a, b in zip(versions, versions[1:], strict=False))


def saved_files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_saved_snapshots_equal_the_history(spark, frame):
    """Closed versions are written once, a day without changes writes nothing at all."""
    path, history = stage_path(spark, "history"), None
    args = (scd2.PRICE_KEY, scd2.PRICE_CHECK_COLUMNS)
    for day in (1, 2, 3, 3, 4, 5, 6):
        prices = [price(p, float(min(day, 5) * n % 3)) for n, p in enumerate("abcd", 1) if day == 6 or day % n != 1]
        prices = prices if day != 4 else prices[:1]
        current, at = frame(PRICES, *prices), f"2024-01-{day:02d} 00:00:00"
        history = scd2.snapshot_prices(history, current, at)
        before = saved_files(path)
        scd2.save_snapshot(spark, path, current, *args, at)
        after = saved_files(path)
        assert all(after[f] == t for f, t in before.items())  # nothing written before is touched
        assert rows(scd2.read_history(spark, path)) == rows(history)
        scd2.save_snapshot(spark, path, current, *args, f"2024-01-{day:02d} 12:00:00")
        assert saved_files(path) == after


def test_a_snapshot_cut_off_is_taken_again(spark, frame, monkeypatch):
    path = stage_path(spark, "history")
    args = (scd2.PRICE_KEY, scd2.PRICE_CHECK_COLUMNS)
    scd2.save_snapshot(spark, path, frame(PRICES, price("a"), price("b")), *args, T1)
    changed = frame(PRICES, price("a", 12.0))
    with monkeypatch.context() as patch:
        patch.setattr(scd2, "rebuild_mart", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            scd2.save_snapshot(spark, path, changed, *args, T2)
    scd2.save_snapshot(spark, path, changed, *args, T2)
    expected = scd2.snapshot_prices(scd2.snapshot_prices(None, frame(PRICES, price("a"), price("b")), T1), changed, T2)
    assert rows(scd2.read_history(spark, path)) == rows(expected)
    assert scd2.read_history(spark, stage_path(spark, "none")) is None


def test_as_of_lookup_takes_the_version_of_the_day(frame):
    versions = frame(
        "product_id string, retail_price double, dbt_valid_from timestamp, dbt_valid_to timestamp",
        ("a", 1.0, T1, T2), ("a", 2.0, T2, None),
    )
    facts = frame("product_id string, at timestamp", ("a", T1), ("a", T2), ("a", "2023-01-01"),
                  ("x", T2), (None, T2))
    found = rows(scd2.as_of_lookup(facts, versions, "product_id", facts["at"]), "retail_price")
    assert found == [(1.0,), (2.0,), (None,), (None,), (None,)]


@pytest.mark.parametrize(
    ("hours", "status"), [(29, "pass"), (30, "pass"), (31, "warn"), (54, "warn"), (55, "error")]
)
def test_freshness(frame, hours, status):
    loaded = frame("created_at timestamp", ("2024-01-01 00:00:00",), ("2023-01-01 00:00:00",))
    now = f"2024-01-{1 + hours // 24:02d} {hours % 24:02d}:00:00"
    row = freshness(loaded, as_of=now).first()
    assert (row.age_hours, row.status) == (float(hours), status)


def test_an_empty_source_is_stale(frame):
    assert freshness(frame("created_at timestamp")).first().status == "error"
