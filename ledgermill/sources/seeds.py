"""Seed tables: small lookup files that belong to the code."""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession

from ledgermill.schemas import THRESHOLDS

# Audit risk tier and materiality threshold per product category.
THRESHOLD_FILE = "audit_materiality_thresholds.csv"


def threshold_file() -> str:
    """Text of the shipped file without its comment."""
    text = resources.files("ledgermill.sources").joinpath(THRESHOLD_FILE).read_text("utf-8")
    return "\n".join(line for line in text.splitlines() if line and not line.startswith("#"))


def thresholds(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The materiality thresholds, from ``path`` or from the file shipped with the package.

    The shipped file has 26 lines and is parsed on the driver, since executors need not
    have the package's data files. No broadcast is forced on a file given by the caller:
    Spark knows its size and picks the join.
    """
    if path is not None:
        return spark.read.schema(THRESHOLDS).csv(path, header=True, comment="#")
    rows = []
    for line in threshold_file().splitlines()[1:]:
        category, tier, threshold, rationale = line.split(",", 3)
        rows.append((category, tier, int(threshold), rationale))
    return spark.createDataFrame(rows, THRESHOLDS)
