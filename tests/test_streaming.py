"""Order marts from a stream of lines: state per order, restarts and failures."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException

from ledgermill.operators import orders
from ledgermill.operators.merge import month_period, read_mart
from ledgermill.session import stage_path
from ledgermill.sources import tables
from ledgermill.streaming import upsert
from ledgermill.streaming.upsert import changed_orders, file_stream, stream_orders
from tests.conftest import rows

SCHEMA = """order_item_id string, order_id string, user_id string, product_id string,
    order_item_status string, sale_price double, created_at timestamp, shipped_at timestamp,
    returned_at timestamp"""
JUNE, JULY = "2024-06-10 00:00:00", "2024-07-02 00:00:00"
BATCHES = [
    [("1", "a", "u", "p", "complete", 10.0, JULY, JULY, None),
     ("2", "b", "u", "p", "shipped", 5.5, JUNE, JUNE, None),
     ("3", None, None, "p", "shipped", 1.0, JUNE, None, None)],
    # order a gets an earlier line, which moves it to another period, and a return
    [("4", "a", "u", "p", "returned", 2.25, JUNE, JULY, JULY),
     ("5", "c", "v", "p", "shipped", None, None, None, None)],
    [("6", "b", "u", "p", "returned", 0.5, JULY, JULY, "2024-07-09 00:00:00"),
     ("7", None, "w", "p", "shipped", 1.0, JUNE, None, None)],
]


class Run:
    """A folder of lines, a mart and a checkpoint."""

    def __init__(self, spark, frame):
        self.spark, self.frame = spark, frame
        self.folder, self.mart = stage_path(spark, "lines"), stage_path(spark, "mart")
        self.checkpoint = stage_path(spark, "stream")
        self.seen = []

    def arrive(self, lines):
        tables.append_parquet(self.frame(SCHEMA, *lines).coalesce(1), self.folder)

    def start(self, model=orders.refund_reconciliation):
        def watched(changed):
            self.seen.append({r[0] for r in changed.select("order_id").collect()})
            return model(changed)

        lines = file_stream(self.spark, self.folder, SCHEMA, per_batch=1)
        period = month_period("order_date")
        stream_orders(
            lines, watched, self.mart, "order_id", self.checkpoint, period
        ).awaitTermination()

    def expected(self, batches):
        lines = [line for batch in batches for line in batch if line[1] is not None]
        return orders.refund_reconciliation(
            orders.aggregate_order_items(self.frame(SCHEMA, *lines)))

    def check(self, batches):
        want = self.expected(batches)
        assert rows(read_mart(self.spark, self.mart, want.schema)) == rows(want)


@pytest.fixture
def run(spark, frame):
    return Run(spark, frame)


def test_a_restarted_stream_equals_the_batch(run):
    """Each start takes the new lines only, and gives on only the orders they change."""
    for count, batch in enumerate(BATCHES, 1):
        run.arrive(batch)
        run.start()
        run.check(BATCHES[:count])
    assert run.seen == [{"a", "b"}, {"a", "c"}, {"b"}]
    run.start()
    assert len(run.seen) == 3  # nothing new, no batch


def test_a_batch_cut_off_is_taken_again(run):
    """A batch that fails after its merge is repeated with the state before it."""
    for batch in BATCHES:
        run.arrive(batch)
    merged = []

    def failing(changed):
        if len(merged) == 1:
            raise RuntimeError("lost")
        merged.append(True)
        return orders.refund_reconciliation(changed)

    with pytest.raises(StreamingQueryException, match="lost"):
        run.start(failing)
    run.check(BATCHES[:1])
    run.start()
    run.check(BATCHES)
    assert run.seen == [{"a", "b"}, {"a", "c"}, {"a", "c"}, {"b"}]


def test_old_lines_are_not_read_again(run):
    """The plan of a batch holds one scan, of its own files, and one shuffle to the state."""
    run.arrive(BATCHES[0])
    lines = file_stream(run.spark, run.folder, SCHEMA)
    query = (
        changed_orders(lines).writeStream.outputMode("update").format("noop")
        .option("checkpointLocation", stage_path(run.spark, "noop"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.count("StateStoreSave") == 1 and plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_state_is_kept_on_disk_and_merges_are_adaptive(run):
    """The state store is RocksDB, merges gather each period, and the session is as before."""
    adaptive = []

    def model(changed):
        adaptive.append(changed.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return orders.refund_reconciliation(changed)

    chosen = "spark.sql.streaming.stateStore.providerClass"
    before = run.spark.conf.get(chosen, None)
    lines = [(str(i), f"o{i}", "u", "p", "complete", 1.0, JUNE, JUNE, None) for i in range(40)]
    run.arrive(lines)
    run.start(model)
    run.check([lines])
    offsets = "".join(run.spark.read.text(f"{run.checkpoint}/offsets").toPandas()["value"])
    assert "RocksDBStateStoreProvider" in offsets
    assert adaptive == ["true"] and run.spark.conf.get(chosen, None) == before
    assert len(run.spark.read.parquet(run.mart + "/gen-00000001").inputFiles()) == 1


def test_a_stream_begun_with_another_state_store_goes_on(run, monkeypatch):
    """A checkpoint names its state store, and a restart takes that one."""
    monkeypatch.setattr(upsert, "STATE_CONF", {})
    run.arrive(BATCHES[0])
    run.start()
    monkeypatch.undo()
    run.arrive(BATCHES[1])
    run.start()
    run.check(BATCHES[:2])
