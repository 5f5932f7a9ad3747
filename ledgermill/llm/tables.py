"""Where the queries find their tables and vocabulary files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TOKENIZERS_VARIABLE = "LEDGERMILL_TOKENIZERS"  # overrides the folder of vocabulary files


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The path of a public vocabulary file; executors need it at the same place."""
    folder = os.environ.get(TOKENIZERS_VARIABLE)
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
