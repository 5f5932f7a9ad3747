"""Benchmark passages in training texts.

The windows of all benchmark items form a hash set that goes to every task; a document is
scanned once, its hits are compared word by word, and no row is shuffled. The set is broadcast
in slices of a bounded number of words: within the bound there is one slice and one scan,
beyond it each slice scans the texts once and the hits of a row are joined.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.text import MIX, letter_words, mixed, raw, with_results
from ledgermill.session import staged

WINDOW = 10
SLICE_WORDS = 500_000
_FIELDS = "n_words long, hit_words array<int>, items array<string>"


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


class WindowSet:
    """The windows of some items: hashes for the scan, exact words behind each hash."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.vocabulary = _Vocabulary()
        self.owners: dict[bytes, set[str | None]] = defaultdict(set)
        hashes = defaultdict(set)
        for name, text in items:
            words = letter_words(text)
            for word in words:
                if word not in self.vocabulary:
                    self.vocabulary[word] = len(self.vocabulary) + 1
            ids = self.numbers(words)
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                self.owners[ids[at : at + size].tobytes()].add(name)
            if size:
                grams = np.lib.stride_tricks.sliding_window_view(ids, size)
                hashes[size].update(self._hash(grams).tolist())
        self.hashes = {n: np.sort(np.array(list(h), np.uint64)) for n, h in hashes.items()}

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words))

    @staticmethod
    def _hash(grams: np.ndarray) -> np.ndarray:
        total = np.full(len(grams), grams.shape[1], np.uint64)
        for column in grams.T:
            total = mixed(total * MIX + column.astype(np.uint64))
        return total

    def find(self, ids: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """(position, length, items) of every window that occurs in ``ids``; 0 never matches."""
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for size, known in self.hashes.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(at):
                continue
            found = self._hash(ids[at[:, None] + np.arange(size)])
            place = np.minimum(np.searchsorted(known, found), len(known) - 1)
            for start in at[known[place] == found].tolist():
                owners = self.owners.get(ids[start : start + size].tobytes())
                if owners:
                    yield start, size, owners


def _scan(windows) -> callable:
    def scan(texts: pa.Array) -> pa.Array:
        index, counts, hits, items = windows.value, [], [], []
        for first in range(0, len(texts), 200):
            split = [letter_words(t) for t in raw(texts.slice(first, 200))]
            sizes = [len(words) for words in split]
            flat = [word for words in split for word in (*words, b"")]  # b"" parts two texts
            ids = index.numbers(flat)
            starts = np.concatenate([[0], np.cumsum(np.array(sizes) + 1)])
            marks, names = defaultdict(set), defaultdict(set)
            for start, size, owners in index.find(ids):
                doc = int(np.searchsorted(starts, start, side="right")) - 1
                marks[doc].update(range(start - starts[doc], start - starts[doc] + size))
                names[doc] |= owners
            counts += sizes
            hits += [sorted(int(x) for x in marks.get(i, ())) for i in range(len(split))]
            items += [sorted(n for n in names.get(i, ()) if n is not None) for i in range(len(split))]
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32()))]
            + [pa.array(items, pa.list_(pa.string()))],
            names=["n_words", "hit_words", "items"],
        )

    return scan


def _slices(
    benchmark: DataFrame, item_column: str, text_column: str, slice_words: int, nameless: bool
):
    """The items as lists of at most about ``slice_words`` words each, one list at a time."""
    items = benchmark.select(
        F.col(item_column).cast("string").alias("name"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    if not nameless:
        items = items.filter("name is not null")
    # a text of n bytes has at most (n + 1) / 2 words
    words = items.agg(F.sum((F.octet_length("text") + 1) / 2)).first()[0] or 0
    count = max(1, -int(-words // slice_words))
    for k in range(count):
        part = items.filter(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == k)
        yield [(r["name"], r["text"].encode()) for r in part.toLocalIterator()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    slice_words: int = SLICE_WORDS,
    nameless: bool = False,
) -> DataFrame:
    """``docs`` plus n_words, hit_words (word positions), items, n_items and contaminated.

    A window is ``window`` consecutive words of an item, or a whole shorter item. Null texts
    have no words and hit nothing; benchmark rows without an id are ignored or, if ``nameless``,
    hit like others and are only left out of the items; rows with the same item id count as
    one item; repeated documents are judged row by row. Columns of ``docs`` with the names of
    results are replaced.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    parts = _slices(benchmark, item_column, item_text_column, slice_words, nameless)
    first, second = next(parts), next(parts, None)
    if second is None:
        shared = context.broadcast(WindowSet(first, window))
        found = with_results(docs, [text_column], _scan(shared), _FIELDS)
    else:
        rows = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "scan")
        texts, hits = rows.select("__row", text_column), None
        for items in chain([first, second], parts):  # one slice at a time is on the executors
            shared = context.broadcast(WindowSet(items, window))
            scan = with_results(texts, [text_column], _scan(shared), _FIELDS)
            scan = scan.filter("size(hit_words) > 0").select("__row", "hit_words", "items")
            scan = staged(scan, "hits")
            shared.destroy()
            hits = scan if hits is None else hits.unionByName(scan)
        merged = hits.groupBy("__row").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("h"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("i"),
        )
        empty = with_results(
            rows, [text_column], _scan(context.broadcast(WindowSet([], window))), _FIELDS
        )
        found = (
            empty.join(merged, "__row", "left")
            .withColumn("hit_words", F.coalesce("h", "hit_words"))
            .withColumn("items", F.coalesce("i", "items"))
            .drop("__row", "h", "i")
        )
    return found.withColumn("n_items", F.size("items").cast("long")).withColumn(
        "contaminated", F.size("hit_words") > 0
    )


def without_spans(found: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``find_contamination`` with the hit words cut out of their texts.

    Each run of hit words goes, from the start of its first to the end of its last word.
    """
    import re

    pattern = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

    def cut(texts: pa.Array, hits: pa.Array) -> pa.Array:
        out = []
        for text, marked in zip(raw(texts), hits.to_pylist(), strict=True):
            if marked:
                spans = [m.span() for m in pattern.finditer(text)]
                kept, last = [], 0
                for run in np.split(np.array(marked), np.flatnonzero(np.diff(marked) > 1) + 1):
                    kept.append(text[last : spans[run[0]][0]])
                    last = spans[run[-1]][1]
                text = b"".join([*kept, text[last:]])
            out.append(text.decode())
        return pa.array(out, pa.string())

    udf = F.arrow_udf(cut, returnType="string")
    cleaned = F.when(F.size("hit_words") > 0, udf(text_column, "hit_words"))
    return found.withColumn(text_column, F.coalesce(cleaned, text_column))


def without_documents(found: DataFrame) -> DataFrame:
    """The rows of ``find_contamination`` that hit nothing."""
    return found.filter("not contaminated")
