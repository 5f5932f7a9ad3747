"""What several operators share: word splitting, 64-bit word hashes, carried columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the word counts: space and \t \n \v \f \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_ALNUM = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32
    for c in range(256)
)
BATCH_ROWS = 2000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BROADCAST_ROWS = 1_000_000  # rows of a few numbers each
MIX = np.uint64(0x9E3779B97F4A7C15)


def raw(array: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    return [b"" if x is None else x for x in array.cast(pa.large_binary()).to_pylist()]


def plain_words(text: bytes) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def letter_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased."""
    return text.translate(_ALNUM).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word. Hashing is cheaper than remembering: vocabularies are open."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64's finalizer)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash per run of ``n`` word hashes; the order of words counts."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, n, np.uint64)
    for i in range(n):
        total *= MIX
        total += hashes[i : i + count]
    return mixed(total)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct n-word shingles; a shorter text is one shingle, no words none."""
    if len(hashes) == 0:
        return np.empty(0, np.uint64)
    return np.unique(ngram_hashes(hashes, min(n, len(hashes))))


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64, copy=False).view(np.int64)


def md5_text(*parts: Column) -> Column:
    """A hash that any SQL engine can repeat; null parts count as the text ``null``."""
    return F.md5(F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def bound_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches that travel to Python small, unless the session says otherwise.

    Batches are cut by rows; texts may be long, and Spark's 10,000 of them fill both sides of
    the pipe.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(BATCH_ROWS))


def give_back() -> None:
    """Freed memory goes back to the system; Python's and Arrow's allocators would keep it for
    as long as the worker lives, beside what the JVM and other workers need."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``function`` over batches of a task, with ``give_back`` at the task's end."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return rows


def small_table(spark: SparkSession, rows: list[tuple], fields: dict[str, pa.DataType]) -> DataFrame:
    """A few rows as a DataFrame. They go as an Arrow table: from a list, Spark would start
    Python workers of another kind on the executors, whose parent process stays."""
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    made = {name: pa.array(c, fields[name]) for name, c in zip(fields, columns, strict=True)}
    return spark.createDataFrame(pa.table(made))


def with_results(
    df: DataFrame, inputs: Iterable[str], function: Callable[..., pa.Array], fields: str
) -> DataFrame:
    """``df`` plus the columns that ``function`` computes from whole Arrow columns.

    Only ``inputs`` travel to Python; the other columns stay in the JVM. A column of the
    input that has the name of a result is replaced.
    """
    bound_batches(df.sparkSession)
    names = [part.split()[0] for part in fields.split(",")]
    udf = F.arrow_udf(function, returnType=f"struct<{fields.replace(' ', ':').replace(',:', ',')}>")
    made = df.withColumn("__made", udf.asNondeterministic()(*[F.col(c) for c in inputs]))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return made.select(*kept, *[F.col("__made")[n].alias(n) for n in names])


def if_small(df: DataFrame) -> DataFrame:
    """``df``, a written table of a few numbers per row, with a broadcast hint if its rows are
    at most ``BROADCAST_ROWS``; beyond, Spark joins it by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
