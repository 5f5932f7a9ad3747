from __future__ import annotations

import pytest

from ledgermill.session import local_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(base / "stage"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testbed(spark):
    from ledgermill.sources.testbed import Testbed

    return Testbed(spark, SF_DIR)


@pytest.fixture
def frame(spark):
    """A frame from a schema and rows; timestamps may be given as text."""

    def build(schema: str, *rows):
        from pyspark.sql import functions as F
        from pyspark.sql.types import StructType, TimestampType

        target = StructType.fromDDL(schema)
        as_text = schema.replace("timestamp", "string").replace(" date", " string")
        df = spark.createDataFrame(list(rows), as_text)
        casts = [
            F.col(f.name).cast(f.dataType).alias(f.name)
            if isinstance(f.dataType, TimestampType) or f.dataType.typeName() == "date"
            else F.col(f.name)
            for f in target.fields
        ]
        return df.select(casts)

    return build


def rows(df, *columns):
    """Sorted plain tuples of a small frame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
