"""The training-corpus pipeline: five stages over ``documents``, each through one operator.

A stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import tables
from ledgermill.llm.decontaminate import find_contamination, without_documents
from ledgermill.llm.mixing import mix_sources
from ledgermill.llm.near import near_copies
from ledgermill.llm.quality import score_quality
from ledgermill.llm.text import WORD_PATTERN, if_small
from ledgermill.llm.tokens import read_documents, write_tokens
from ledgermill.session import stage_path, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Scores come from the text alone."""
    scored = score_quality(docs, tables.read(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select(*docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``__row``, a key of its own for each row that every scan repeats.

    It begins with a hash of the whole row, so that keys order rows by content, wherever they
    stand; only rows equal in all columns are told apart by their file and place, and which of
    those is first makes no difference. Rows of other frames are written with a number.
    """
    content = [F.xxhash64(*docs.columns), F.xxhash64(F.lit(1), *docs.columns)]
    try:
        place = [F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")]
        found = docs.withColumn("__row", F.struct(*content, *place))
        found.schema  # noqa: B018  fails for frames without files
        return found
    except AnalysisException:
        number = F.monotonically_increasing_id()
        return staged(docs.withColumn("__row", F.struct(*content, number)), "keyed")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: the one with the smallest id, null ids last;
    of those that share it, the one with the least hash of the whole row.

    Rows without words are in no group and stay; those that repeat an id and a text stay once.
    """
    rows = keyed(docs)
    groups = near_copies(rows, id_column="__row")
    blank = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    empty_text = F.when(~F.coalesce(F.regexp_like("text", F.lit(WORD_PATTERN)), F.lit(False)), F.col("text"))
    placed = (
        rows.select("__row", "doc_id", empty_text.alias("text"))
        .join(groups.withColumnRenamed("doc_id", "__row"), "__row")
        .select(
            F.struct(
                F.when(~blank, F.col("component_id")).alias("component"),
                F.when(blank, F.col("doc_id")).alias("id"),
                F.when(blank, F.col("text")).alias("text"),
            ).alias("group"),
            F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "__row").alias("place"),
        )
    )
    placed = staged(placed, "groups")
    first = placed.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    first = first.filter("rows > 1").withColumnRenamed("group", "__group")
    gone = placed.join(first, F.col("group").eqNullSafe(F.col("__group"))).filter("place.__row <> first.__row")
    gone = if_small(staged(gone.select("place.__row"), "gone"))
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, whether the item has an id or not."""
    found = find_contamination(docs, tables.read(spark, sf_dir, "benchmark"), nameless=True)
    return without_documents(found).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it: its words taken over its words, rounded. Rows
    without words are taken never."""
    rows = keyed(docs)
    mixed = mix_sources(rows, key_column="__row").filter("taken > 0")
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = mixed.select("__row", copies.alias("__copies")).filter("__copies > 0")
    joined = rows.join(if_small(staged(taken, "taken")), "__row")
    repeated = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return repeated.select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in block files; one row per document as the files have it."""
    path = stage_path(spark, "tokens")
    write_tokens(docs, path, tables.tokenizer("byte_bpe_50k.json"), end_id=2)
    return read_documents(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_files", token_files),
]

# The classifier, the n-gram sets and the tokenizer have no SQL form; the stages are tested
# against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
