"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgermill.catalog.prelude import with_models
from ledgermill.sources.testbed import Testbed


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Testbed], DataFrame]
    sql: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Testbed(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the test tables, with SQL that must give the same rows."""

    def register(build: Callable[[Testbed], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, with_models(sql) if sql else None)
        return build

    return register
