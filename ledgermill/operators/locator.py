"""Where the keys of a mart are: one row per key and period, in buckets of the key's hash.

A merge must find the periods that hold a key of its batch. Instead of the key column of the
whole mart it reads the buckets its keys fall into. The locator may list a period that no
longer holds a key, never miss one that does: a batch adds its places before its rows are
written, and a new generation of the mart starts a new locator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

BUCKETS = 64
_BUCKET = "key_bucket"
_KEY = "located_key"


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(BUCKETS)).cast("int")


class KeyLocator:
    """The locator of one generation of a mart, kept in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, period: str):
        self.spark, self.path, self.key, self.period = spark, path, key, period

    def _places(self, rows: DataFrame) -> DataFrame:
        known = rows.filter(F.col(self.key).isNotNull())
        return known.select(F.col(self.key).alias(_KEY), self.period).distinct()

    def _write(self, places: DataFrame, mode: str) -> None:
        bucketed = places.withColumn(_BUCKET, _bucket(F.col(_KEY)))
        # one file per bucket: a batch opens as many files as it has buckets
        dealt = bucketed.repartition(_BUCKET).sortWithinPartitions(_BUCKET, _KEY)
        dealt.write.mode(mode).partitionBy(_BUCKET).parquet(self.path)

    def build(self, mart: DataFrame) -> None:
        """List every key of the mart: once per generation."""
        self._write(self._places(mart), "overwrite")

    def find(self, batch: DataFrame) -> DataFrame:
        """(key, period): the periods that may hold a key of ``batch``."""
        fields = [
            batch.schema[self.key], StructField(self.period, StringType()), StructField(_BUCKET, IntegerType())
        ]
        fields[0] = StructField(_KEY, fields[0].dataType)
        keys = batch.select(F.col(self.key).alias(_KEY)).filter(F.col(_KEY).isNotNull())
        buckets = keys.select(_bucket(F.col(_KEY))).distinct().collect()  # at most BUCKETS numbers
        listed = self.spark.read.schema(StructType(fields)).parquet(self.path)
        near = listed.filter(F.col(_BUCKET).isin([row[0] for row in buckets]))
        return near.drop(_BUCKET).join(keys, _KEY, "left_semi").withColumnRenamed(_KEY, self.key)

    def add(self, batch: DataFrame, known: DataFrame) -> None:
        """List the places of ``batch`` that are not ``known`` yet, as new files."""
        fresh = self._places(batch).join(
            known.withColumnRenamed(self.key, _KEY), [_KEY, self.period], "left_anti"
        )
        self._write(fresh, "append")
