"""Daily appends as a file stream: each micro-batch is merged into a mart.

A mart at line grain needs no more than the batch (``stream_upsert``). A mart at order grain
needs the earlier lines of the orders a batch touches: ``stream_orders`` keeps one aggregate
per order as Spark's streaming state, so that no batch reads old lines again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgermill.operators.merge import merge_mart
from ledgermill.operators.orders import aggregate_order_items
from ledgermill.session import settings

# The state of a stream of orders lives on the executors' disks, in a bounded part of their memory.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",  # one read a write
}


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: str | StructType,
    files: str = "*.parquet",
    per_batch: int = 1000,
) -> DataFrame:
    """New parquet files of a folder, a bounded number per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", per_batch)
        .parquet(folder)
    )


def touched_orders(all_items: DataFrame, batch: DataFrame) -> DataFrame:
    """All lines of the orders a batch has lines of, for marts at order grain."""
    return all_items.join(batch.select("order_id").distinct(), "order_id", "left_semi")


def stream_upsert(
    stream: DataFrame,
    model: Callable[[DataFrame], DataFrame],
    mart_path: str,
    key: str,
    checkpoint: str,
    period: Column | None = None,
) -> StreamingQuery:
    """Merge ``model`` of every micro-batch into the mart, for all data there is now.

    The checkpoint records which files were taken. A batch repeated after a failure merges
    to the same mart, so the result is exactly once.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_mart(batch.sparkSession, mart_path, model(batch), key, period)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def changed_orders(lines: DataFrame) -> DataFrame:
    """Sub-ledger of a stream of order lines; in update mode, of the orders that changed.

    Partial aggregates of a batch meet the state of their orders in one shuffle of the batch,
    whatever was read before. The state holds one row per order and lives in the checkpoint.
    Lines without an order have no key to be merged by and are left out, as the incremental
    order marts do.
    """
    return aggregate_order_items(lines.filter("order_id is not null"))


def stream_orders(
    lines: DataFrame,
    model: Callable[[DataFrame], DataFrame],
    mart_path: str,
    key: str,
    checkpoint: str,
    period: Column | None = None,
) -> StreamingQuery:
    """Merge ``model`` of the changed orders of every micro-batch, for all data there is now.

    ``model`` takes the sub-ledger of the changed orders, whole orders with all their lines so
    far. State and file offsets are committed after the merge: a batch repeated after a
    failure finds the state before it, gives the same orders and merges to the same mart.

    The state store is RocksDB, so a ledger need not fit the executors' memory; a checkpoint
    that was begun with another one goes on with that. Spark plans a stateful stream without
    adaptive execution, but a merge reads no state and is planned with it: else every task
    writes a small file into every period.
    """

    def merge(changed: DataFrame, _batch_id: int) -> None:
        with settings(changed.sparkSession, spark__sql__adaptive__enabled="true"):
            merge_mart(changed.sparkSession, mart_path, model(changed), key, period)

    with settings(lines.sparkSession, **STATE_CONF):
        return (
            changed_orders(lines)
            .writeStream.outputMode("update")
            .foreachBatch(merge)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
