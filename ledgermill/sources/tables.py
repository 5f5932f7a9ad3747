"""Parquet sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.operators.layout import clustered
from ledgermill.schemas import GROWING_TABLES, RAW_TABLES
from ledgermill.session import shuffles_dropped


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan ``{root}/{name}.parquet`` with its declared schema.

    A growing table that was never written yet reads as empty; a missing extracted table
    is an error.
    """
    schema = RAW_TABLES[name]
    path = f"{root.rstrip('/')}/{name}.parquet"
    if name in GROWING_TABLES and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def load_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: load(spark, root, name) for name in RAW_TABLES}


def write_parquet(df: DataFrame, path: str) -> bool:
    """Overwrite ``path``; an empty frame leaves it untouched. True when written."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def append_parquet(df: DataFrame, path: str, cluster_by: tuple[str, ...] = ()) -> None:
    """Add a daily batch as new files; the files already there are not read.

    ``cluster_by`` names the times a look-back filters by: the files are laid out along a
    Z-curve through them.
    """
    rows = clustered(df, cluster_by) if cluster_by else df
    with shuffles_dropped(df.sparkSession):
        rows.write.mode("append").parquet(path)


def export_csv(marts: dict[str, DataFrame], out_dir: str) -> None:
    """Write each mart as a folder of CSV part files with headers.

    Every task writes its own part, so no mart passes through one task or the driver.
    """
    for name, df in marts.items():
        (
            df.write.mode("overwrite")
            .option("header", True)
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(f"{out_dir.rstrip('/')}/{name}")
        )


def materialize(df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """Publish a model as a temporary ``view`` or a fully rebuilt ``table``.

    Keyed incremental tables go through ``operators.merge``.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite")
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"unknown kind of model: {kind}")
    return spark.table(name)
