"""Keyed merge into marts kept as parquet, with schema sync.

A mart is a folder of generations, each partitioned by period. A full rebuild writes the
next generation, and readers take the newest complete one (Spark's own ``_SUCCESS`` marker
tells), so a failed rebuild leaves the mart as it was. A merge rewrites only the periods
that hold a row of the batch, before or after: a daily batch touches a few months of a
ledger of many years, and a key locator tells which without a scan of the mart. Running the
same merge again gives the same mart, which is also the way to recover from one that was cut
off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgermill.operators.layout import z_value
from ledgermill.operators.locator import KeyLocator
from ledgermill.session import shuffles_dropped, staged

GENERATION = "gen-"
LOCATOR = "keys-"
MOST_PERIODS = 2_000  # in a filter that names them; more are joined
PERIOD = "mart_period"
NO_PERIOD = "none"


def sync_columns(target: DataFrame, schema: StructType) -> DataFrame:
    """The target with the columns of ``schema``: new ones NULL, vanished ones dropped."""
    columns = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in target.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return target.select(columns)


def duplicate_keys(updates: DataFrame, key: str) -> DataFrame:
    counted = updates.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col(key).isNotNull() & (F.col("rows") > 1))


def _repeated_keys(key: str, repeated: list[Row]) -> ValueError:
    return ValueError(f"duplicate {key} in the updates: {[row[key] for row in repeated]}")


def unique_keys(updates: DataFrame, key: str) -> DataFrame:
    """The keys of a batch; reading them fails when one occurs twice."""
    message = F.concat(F.lit(f"duplicate {key} in the updates: "), F.col(key).cast("string"))
    counted = updates.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    failure = F.raise_error(message).cast(updates.schema[key].dataType)
    known = counted.filter(F.col(key).isNotNull())
    return known.select(F.when(F.col("rows") == 1, F.col(key)).otherwise(failure).alias(key))


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Replace rows whose key is in the updates, add new keys, keep the rest."""
    kept = sync_columns(target, updates.schema).join(unique_keys(updates, key), key, "left_anti")
    return kept.unionByName(updates)


def month_period(ts: str) -> Column:
    """Partition value for a timestamp column."""
    return F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit(NO_PERIOD))


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def generations(spark: SparkSession, path: str) -> list[str]:
    """Complete generations of a mart, oldest first."""
    folder, fs = _hadoop_path(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    found = [n for n in names if n.startswith(GENERATION)]
    return sorted(n for n in found if fs.exists(_hadoop_path(spark, f"{path}/{n}/_SUCCESS")[0]))


def current_path(spark: SparkSession, path: str) -> str | None:
    complete = generations(spark, path)
    return f"{path}/{complete[-1]}" if complete else None


def fs_exists(spark: SparkSession, path: str) -> bool:
    found, fs = _hadoop_path(spark, path)
    return fs.exists(found)


def key_locator(spark: SparkSession, path: str, key: str) -> KeyLocator:
    """The locator of the newest generation of a mart, in a folder beside it."""
    number = generations(spark, path)[-1].removeprefix(GENERATION)
    return KeyLocator(spark, f"{path}/{LOCATOR}{number}", key, PERIOD)


def _read_periods(
    spark: SparkSession, folder: str, schema: StructType | None = None
) -> DataFrame:
    """A generation with its period column.

    A declared schema reads old files too: columns they lack are NULL, columns no longer
    declared are skipped. Only without one are the schemas of all files merged, which opens
    every footer.
    """
    if schema is None:
        mart = spark.read.option("mergeSchema", True).parquet(folder)
        return mart.withColumn(PERIOD, F.col(PERIOD).cast("string"))
    fields = [f for f in schema.fields if f.name != PERIOD]
    full = StructType([*fields, StructField(PERIOD, StringType())])
    return spark.read.schema(full).parquet(folder)


def read_mart(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """The newest complete generation of a mart, or None before the first."""
    folder = current_path(spark, path)
    if folder is None:
        return None
    return _read_periods(spark, folder, schema).drop(PERIOD)


def _write_periods(
    rows: DataFrame, folder: str, by_period: bool, cluster_by: tuple[str, ...], **options: str
) -> None:
    """Write rows in their period folders.

    The rebalance hint gathers each period into files of the advised size, splits a period
    that holds most of the rows, and keeps a thousand tasks from writing a thousand small
    files per period. With ``cluster_by`` each file is sorted along the Z-curve of those times,
    so that its row groups can be skipped by any of them.
    """
    balanced = rows.hint("rebalance", PERIOD) if by_period else rows.hint("rebalance")
    if cluster_by:
        balanced = balanced.sortWithinPartitions(PERIOD, z_value(cluster_by))
    options = {"partitionOverwriteMode": "static"} | options
    with shuffles_dropped(rows.sparkSession):
        balanced.write.mode("overwrite").options(**options).partitionBy(PERIOD).parquet(folder)


def rebuild_mart(
    df: DataFrame, path: str, period: Column | None = None, cluster_by: tuple[str, ...] = ()
) -> None:
    """Write ``df`` as the next generation."""
    complete = generations(df.sparkSession, path)
    number = int(complete[-1].removeprefix(GENERATION)) + 1 if complete else 1
    rows = df.withColumn(PERIOD, F.lit(NO_PERIOD) if period is None else period)
    _write_periods(rows, f"{path}/{GENERATION}{number:08d}", period is not None, cluster_by)


def _create_mart(
    rows: DataFrame, path: str, key: str, by_period: bool, cluster_by: tuple[str, ...]
) -> None:
    """Write the first generation, with its period column, straight from the plan of ``rows``.

    Its keys are counted in the written files, and only then Spark's marker makes it complete.
    """
    spark, folder = rows.sparkSession, f"{path}/{GENERATION}{1:08d}"
    unmarked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    _write_periods(rows, folder, by_period, cluster_by, **unmarked)
    repeated = duplicate_keys(_read_periods(spark, folder, rows.schema), key).limit(3).collect()
    found, fs = _hadoop_path(spark, folder)
    if repeated:
        fs.delete(found, True)
        raise _repeated_keys(key, repeated)
    fs.create(_hadoop_path(spark, f"{folder}/_SUCCESS")[0]).close()


def prune_generations(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` complete generations, with their key locators.

    Frames read from a deleted generation can no longer be evaluated, so ``keep`` should cover
    the runs whose readers may still be at work. Gives the names deleted.
    """
    if keep < 1:
        raise ValueError("the newest generation is the mart; keep at least one")
    old = generations(spark, path)[:-keep]
    for name in old:
        for folder in (name, LOCATOR + name.removeprefix(GENERATION)):
            found, fs = _hadoop_path(spark, f"{path}/{folder}")
            fs.delete(found, True)
    return old


def merge_mart(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str,
    period: Column | None = None,
    cluster_by: tuple[str, ...] = (),
) -> None:
    """Merge a batch into a mart; the first batch creates it."""
    place = F.lit(NO_PERIOD) if period is None else period
    folder = current_path(spark, path)
    if folder is None:
        _create_mart(updates.withColumn(PERIOD, place), path, key, period is not None, cluster_by)
        return
    batch = staged(updates.withColumn(PERIOD, place), "batch")
    repeated = duplicate_keys(batch, key).limit(3).collect()
    if repeated:
        raise _repeated_keys(key, repeated)
    mart = _read_periods(spark, folder, batch.schema)
    locator = key_locator(spark, path, key)
    if not fs_exists(spark, f"{locator.path}/_SUCCESS"):
        locator.build(mart)
    known = staged(locator.find(batch), "places")
    locator.add(batch, known)
    places = staged(known.select(PERIOD).union(batch.select(PERIOD)).distinct(), "touched")
    # Periods are calendar months: the driver sees a short list, never rows.
    touched = {row[PERIOD] for row in places.collect()}
    if len(touched) <= MOST_PERIODS:
        near = mart.filter(F.col(PERIOD).isin(list(touched)))
    else:
        near = mart.join(places, PERIOD, "left_semi")
    rows = staged(upsert(near, batch, key), "merged")
    left = {row[PERIOD] for row in rows.select(PERIOD).distinct().collect()}
    by_period = period is not None
    _write_periods(rows, folder, by_period, cluster_by, partitionOverwriteMode="dynamic")
    for emptied in touched - left:
        partition, fs = _hadoop_path(spark, f"{folder}/{PERIOD}={emptied}")
        fs.delete(partition, True)
