"""An audit of sources: how far the term frequencies of one source lie from another's.

Terms worth comparing occur in at least ``least`` documents of their group (a language). They
are found by iceberg refinement: a prefix in too few documents cannot start such a term. Every
level counts the documents of each longer prefix whose parent is kept, drops those below the
threshold, and ends when all kept prefixes are complete terms. The counts of sources follow in
one pass over the kept terms alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm.text import bound_batches, raw
from ledgermill.session import staged

LEAST = 30
TOP_TERMS = 50
UNIT = 1_000_000_000  # shares are counted in billionths
SMOOTHING = 5
FIRST_SIZE = 8  # bytes of the first level's prefixes; every level doubles it
KEPT_BYTES = 24_000_000  # of prefixes or terms in one pass; more are taken in slices
KEY_BYTES = 90  # what a key takes besides its bytes
HELD_KEYS = 500_000  # counters or remembered terms of a task
HELD_OCCURRENCES = 3_000_000  # term numbers of a task that are held before they are counted
REMEMBERED_BYTES = 100  # longer terms are looked up anew
BLOCK = 256  # sources that are compared at once
CHUNK = 512  # terms of one comparison task

_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 32 for c in range(256)
)
_LOWEST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of n bytes
Kept = dict[str, dict[bytes, int]]
Batches = Iterable[pa.RecordBatch]


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_LETTERS).split()


@dataclass
class Words:
    """The terms of several texts as arrays: where each begins and ends in ``data``, the place of
    its text, its length and its first bytes, up to 8, as a little-endian number. No term holds
    a zero byte, so numbers are equal for equal beginnings only."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    sizes: np.ndarray
    heads: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        data = b" " + b" ".join(texts).translate(_LETTERS) + b" " * 8
        inside = np.frombuffer(data, np.uint8) != 32
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        after = 1 + np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        number = np.diff(np.searchsorted(starts, after), prepend=0)
        sizes = ends - starts
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # at every byte
        heads = eight[starts] & _LOWEST[np.minimum(sizes, 8)]
        return cls(data, starts, ends, np.repeat(np.arange(len(texts)), number), sizes, heads)

    def taken(self, where: np.ndarray) -> list[bytes]:
        """The terms at these places."""
        data, bounds = self.data, zip(self.starts[where].tolist(), self.ends[where].tolist(), strict=True)
        return [data[a:b] for a, b in bounds]


def _heads_of(keys: Iterable[bytes], size: int = 8) -> np.ndarray:
    """The sorted first bytes of keys, as ``Words.heads`` has them."""
    return np.unique(np.array([int.from_bytes(k[:size], "little") for k in keys], np.uint64))


def _places(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``values`` are among the sorted ``known`` ones, and where those stand."""
    if not len(known):
        return np.zeros(len(values), bool), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    found = known[at] == values
    return found, at[found]


def _slices(kept: DataFrame) -> Iterator[Kept]:
    """The keys of ``kept`` (lang, key, number) in parts of bounded size, one after the other."""
    size = kept.agg(F.sum(F.octet_length("key") + F.octet_length("lang") + KEY_BYTES)).first()[0] or 0
    parts = -(-size // KEPT_BYTES)
    for part in range(parts):
        rows = kept.filter(F.pmod(F.xxhash64("lang", "key"), F.lit(parts)) == part)
        found: Kept = {}
        for lang, key, number in rows.select("lang", "key", "number").collect():  # at most KEPT_BYTES
            found.setdefault(lang, {})[bytes(key)] = number
        yield found


def _passes(docs: DataFrame, kept: DataFrame, make: Callable, keys: str, amount: str) -> DataFrame:
    """``amount`` by ``keys``, summed over one pass of ``docs`` per slice of ``kept``.

    A pass runs ``make(slice)`` over Arrow batches; its sums are written before the slice
    leaves the executors.
    """
    spark, names = docs.sparkSession, [k.split()[0] for k in keys.split(", ")]
    fields, found = f"{keys}, {amount} long", None
    for part in _slices(kept):
        shared = spark.sparkContext.broadcast(part)
        counted = docs.mapInArrow(make(shared), fields).groupBy(*names).agg(F.sum(amount).alias(amount))
        counted = staged(counted, amount)
        shared.destroy()
        found = counted if found is None else found.unionByName(counted)
    return spark.createDataFrame([], fields) if found is None else found


class _Prefixes(dict):
    """Terms to their key on one level: None below parents that are not kept."""

    def __init__(self, known: dict[bytes, int], size: int, parent: int):
        self.known, self.size, self.parent = known, size, parent

    def __missing__(self, term: bytes) -> bytes | None:
        key = term[: self.size] if term[: self.parent] in self.known else None
        if len(term) <= REMEMBERED_BYTES:
            self[term] = key
        return key


def _coded(values: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct values, and for each value its place among them."""
    names = {value: place for place, value in enumerate(dict.fromkeys(values))}
    return list(names), np.fromiter(map(names.__getitem__, values), np.int64, len(values))


def _by_lang(langs: list[str], words: Words) -> Iterator[tuple[str, np.ndarray]]:
    """The places of the terms of each language, in the order of texts."""
    names, code = _coded(langs)
    code = code[words.text]
    for number, lang in enumerate(names):
        yield lang, np.flatnonzero(code == number)


def _first_counts(shared, size: int) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """What ``_document_counts`` gives for prefixes of up to 8 bytes without a parent."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        number = 0

        def summed() -> int:
            for lang, parts in held.items():
                keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                docs = np.zeros(len(keys), np.int64)
                np.add.at(docs, place, np.concatenate([n for _, n in parts]))
                held[lang] = [(keys, docs)]
            return sum(len(keys) for [(keys, _)] in held.values())

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, [(keys, docs)] in held.items():
                data = keys.astype("<u8").view(np.uint8).reshape(-1, 8)
                ends = np.concatenate([[0], np.cumsum((data > 0).sum(1))]).astype(np.int32)
                buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[data > 0].tobytes())]
                named = pa.Array.from_buffers(pa.binary(), len(keys), buffers)
                langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(keys), np.int64)))
                yield pa.RecordBatch.from_arrays([langs, named, pa.array(docs)], names=["lang", "key", "docs"])
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                langs, words = part.column(0).to_pylist(), Words.of(raw(part.column(1)))
                for lang, places in _by_lang(langs, words):
                    if lang not in shared.value or not len(places):
                        continue
                    keys, rank = np.unique(words.heads[places] & _LOWEST[size], return_inverse=True)
                    once = np.unique(rank * len(langs) + words.text[places])
                    docs = np.bincount(once // len(langs), minlength=len(keys))
                    held.setdefault(lang, []).append((keys, docs))
                    number += len(keys)
                if number > 2 * HELD_KEYS:
                    number = summed()
                    if number > HELD_KEYS:
                        yield from handed_on()
                        number = 0
        summed()
        yield from handed_on()

    return count


def _document_counts(shared, size: int, parent: int) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Batches of (lang, text) to batches of (lang, key, docs)."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        levels = {lang: _Prefixes(known, size, parent) for lang, known in shared.value.items()}
        begun = min(parent, 8)  # bytes that rule out most terms before they are looked up
        parents = {lang: _heads_of(known, begun) for lang, known in shared.value.items()}
        counts: dict[str, Counter] = {lang: Counter() for lang in levels}

        def handed_on() -> pa.RecordBatch:
            langs = [lang for lang, counter in counts.items() for _ in range(len(counter))]
            keys = [key for counter in counts.values() for key in counter]
            docs = [n for counter in counts.values() for n in counter.values()]
            for counter in counts.values():
                counter.clear()
            columns = [pa.array(langs, pa.string()), pa.array(keys, pa.binary()), pa.array(docs, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "key", "docs"])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # texts may be long: a few at a time
                part = batch.slice(at, 500)
                langs, words = part.column(0).to_pylist(), Words.of(raw(part.column(1)))
                for lang, places in _by_lang(langs, words):
                    if lang not in levels:
                        continue
                    level, heads = levels[lang], words.heads[places] & _LOWEST[begun]
                    long = (words.sizes[places] >= parent) & _places(heads, parents[lang])[0]
                    places = places[long]
                    terms, texts = words.taken(places), words.text[places]
                    cuts = [0, *(np.flatnonzero(np.diff(texts)) + 1).tolist(), len(terms)]
                    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                        found = set(map(level.__getitem__, terms[start:end]))
                        found.discard(None)
                        counts[lang].update(found)
                    if len(level) > HELD_KEYS:
                        level.clear()
            if sum(map(len, counts.values())) > HELD_KEYS:
                yield handed_on()
        yield handed_on()

    return count


def frequent_terms(docs: DataFrame, least: int = LEAST, first: int = FIRST_SIZE) -> DataFrame:
    """(lang, term, number, docs): the terms of ``docs`` (lang, text) in at least ``least``
    rows, each with a number of its own."""
    spark = docs.sparkSession
    none = F.lit(0).cast("long").alias("number")
    kept = staged(docs.select("lang").distinct().select("lang", F.lit(b"").alias("key"), none), "langs")
    size, parent, found = first, 0, None
    while not kept.isEmpty():
        if parent == 0 and size <= 8:
            make = partial(_first_counts, size=size)
        else:
            make = partial(_document_counts, size=size, parent=parent)
        counts = _passes(docs, kept, make, "lang string, key binary", "docs").filter(F.col("docs") >= least)
        whole = F.octet_length("key") < size  # shorter than the level: the term ends here
        terms = counts.filter(whole).withColumnRenamed("key", "term")
        found = terms if found is None else found.unionByName(terms)
        kept = counts.filter(~whole).withColumn("number", none)
        size, parent = 2 * size, size
    if found is None:
        return spark.createDataFrame([], "lang string, term binary, docs long, number long")
    return staged(found.withColumn("number", F.monotonically_increasing_id()), "terms")


def _occurrences(shared) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Batches of (lang, source, text) to batches of (source, number, count)."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        short, numbers_of, longer, begun = {}, {}, {}, {}
        for lang, known in shared.value.items():
            own = {int.from_bytes(term, "little"): n for term, n in known.items() if len(term) <= 8}
            short[lang] = np.array(sorted(own), np.uint64)
            numbers_of[lang] = np.array([own[k] for k in short[lang].tolist()], np.int64)
            longer[lang] = {term: n for term, n in known.items() if len(term) > 8}
            begun[lang] = _heads_of(longer[lang])

        def handed_on() -> Iterator[pa.RecordBatch]:
            for source, parts in held.items():
                numbers, counts = np.unique(np.concatenate(parts), return_counts=True)
                places = pa.array(np.zeros(len(numbers), np.int32))
                sources = pa.DictionaryArray.from_arrays(places, pa.array([source], pa.string()))
                columns = [sources.cast(pa.string()), pa.array(numbers), pa.array(counts.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["source", "number", "count"])
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                langs, (names, code) = part.column(0).to_pylist(), _coded(part.column(1).to_pylist())
                words = Words.of(raw(part.column(2)))
                for lang, places in _by_lang(langs, words):
                    if not shared.value.get(lang):
                        continue
                    whole = words.sizes[places] <= 8
                    within, at_short = _places(words.heads[places[whole]], short[lang])
                    rest = places[~whole]
                    rest = rest[_places(words.heads[rest], begun[lang])[0]]
                    found = [longer[lang].get(term, -1) for term in words.taken(rest)]
                    numbers = np.concatenate([numbers_of[lang][at_short], np.array(found, np.int64)])
                    texts = words.text[np.concatenate([places[whole][within], rest])]
                    texts, numbers = texts[numbers >= 0], numbers[numbers >= 0]
                    size += len(numbers)
                    order = np.argsort(code[texts], kind="stable")
                    cuts = np.searchsorted(code[texts][order], np.arange(len(names) + 1))
                    for i, source in enumerate(names):
                        if cuts[i] < cuts[i + 1]:
                            held.setdefault(source, []).append(numbers[order[cuts[i] : cuts[i + 1]]])
                if size > HELD_OCCURRENCES:
                    yield from handed_on()
                    size = 0
        yield from handed_on()

    return count


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, term, count): occurrences of kept terms, without zeros.

    A number stands for a term and its language until the counts are summed.
    """
    kept = terms.select("lang", F.col("term").alias("key"), "number")
    counts = _passes(docs, kept, _occurrences, "source string, number long", "count")
    return counts.join(terms.drop("docs"), "number").select("lang", "source", "term", "count")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 5) / (total + 5 * terms)), exact for all counts."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")
    below = (total + SMOOTHING * terms).cast("decimal(20,0)")
    return F.when(terms == 0, F.lit(0)).otherwise(1 + F.call_function("div", above, below))


def _compared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums over rows of the absolute difference of every column of ``a`` and of ``b``."""
    return np.stack([np.abs(b - a[:, i : i + 1]).sum(0) for i in range(a.shape[1])])


def _compare_blocks(table: pa.Table, block_size: int) -> pa.Table:
    """The sums of one chunk of terms for the sources of two blocks.

    Rows hold one term's shares in one block; the row without a term has the shares that
    terms without an occurrence have there, for every source of the block.
    """
    rows = table.to_pylist()
    key = {n: rows[0][n] for n in ("lang", "left", "right")}
    bases = {r["block"]: r for r in rows if r["term"] is None}
    terms = sorted({r["term"] for r in rows if r["term"] is not None})
    place = {t: i for i, t in enumerate(terms)}
    dense = {}
    for block, base in bases.items():
        values = np.zeros(max(base["columns"]) + 1, np.int64)
        values[base["columns"]] = base["shares"]
        dense[block] = np.tile(values, (len(terms), 1))
    for r in rows:
        if r["term"] is not None:
            dense[r["block"]][place[r["term"]], r["columns"]] = r["shares"]
    sums = _compared(dense[key["left"]], dense[key["right"]])
    i, j = np.indices(sums.shape)
    size = sums.size
    return pa.table({
        "lang": pa.array([key["lang"]] * size, pa.string()),
        "left": pa.array((i + key["left"] * block_size).ravel(), pa.int64()),
        "right": pa.array((j + key["right"] * block_size).ravel(), pa.int64()),
        "apart": pa.array(sums.ravel(), pa.int64()),
        "seen": pa.array(np.full(size, len(terms)), pa.int64()),
    })


@dataclass
class SourceAudit:
    """terms: (lang, term, docs, number); groups: (lang, source, total, terms, number, base);
    shares: (lang, source, term, count, share), without terms that do not occur there."""

    terms: DataFrame
    groups: DataFrame
    shares: DataFrame

    def distances(self) -> DataFrame:
        """(lang, source, other, value): the summed difference of two sources' shares over all
        kept terms, for every two sources of a group.

        Shares stand in arrays of up to ``BLOCK`` sources; two blocks meet per chunk of terms
        and only their sums leave the task. Terms in neither block are added by their number.
        """
        groups = self.groups
        blocks = groups.withColumn("block", F.expr(f"number div {BLOCK}")).withColumn(
            "column", (F.col("number") % BLOCK).cast("int")
        )
        chunks = max(1, -(-self.terms.count() // CHUNK))
        pack = F.collect_list(F.struct("column", "share"))
        cells = (
            self.shares.join(blocks.select("lang", "source", "block", "column"), ["lang", "source"])
            .groupBy("lang", "term", "block")
            .agg(pack.alias("cells"))
            .withColumn("chunk", F.pmod(F.xxhash64("term"), F.lit(chunks)))
        )
        bases = (
            blocks.withColumn("share", F.col("base"))
            .groupBy("lang", "block")
            .agg(pack.alias("cells"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<long>")))
            .withColumn("term", F.lit(None).cast("binary"))
        )
        last = groups.groupBy("lang").agg(F.max(F.expr(f"number div {BLOCK}")).alias("last"))
        met = (
            cells.unionByName(bases)
            .join(last, "lang")
            .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
            .select(
                "lang",
                F.least("block", "with").alias("left"),
                F.greatest("block", "with").alias("right"),
                "chunk",
                "block",
                "term",
                F.col("cells.column").alias("columns"),
                F.col("cells.share").alias("shares"),
            )
        )
        block_size = BLOCK

        def compare(table: pa.Table) -> pa.Table:
            return _compare_blocks(table, block_size)

        sums = met.groupBy("lang", "left", "right", "chunk").applyInArrow(
            compare, "lang string, left long, right long, apart long, seen long"
        )
        sums = sums.filter("left < right").groupBy("lang", "left", "right")
        sums = sums.agg(F.sum("apart").alias("apart"), F.sum("seen").alias("seen"))

        def named(side: str) -> DataFrame:
            return groups.select(
                "lang",
                F.col("number").alias(side),
                F.col("source").alias(f"{side}_source"),
                F.col("base").alias(f"{side}_base"),
                *(["terms"] if side == "left" else []),
            )

        found = sums.join(named("left"), ["lang", "left"]).join(named("right"), ["lang", "right"])
        unseen = (F.col("terms") - F.col("seen")) * F.abs(F.col("left_base") - F.col("right_base"))
        sides = [("left_source", "right_source"), ("right_source", "left_source")]
        both = F.array(*[F.struct(F.col(a).alias("source"), F.col(b).alias("other")) for a, b in sides])
        return found.select(
            "lang", F.inline(both), (F.col("apart") + unseen).cast("long").alias("value")
        )

    def lifted(self, top: int = TOP_TERMS) -> DataFrame:
        """(lang, source, term, value, rank): the terms a source has more of than its group,
        the ``top`` furthest above the group's share."""
        within = self.shares.groupBy("lang", "term").agg(F.sum("count").alias("all"))
        totals = self.groups.groupBy("lang").agg(
            F.sum("total").alias("lang_total"), F.max("terms").alias("lang_terms")
        )
        usual = within.join(totals, "lang").select(
            "lang", "term", share(F.col("all"), F.col("lang_total"), F.col("lang_terms")).alias("usual")
        )
        above = (
            self.shares.join(usual, ["lang", "term"])
            .select("lang", "source", F.col("term").cast("string").alias("term"),
                    (F.col("share") - F.col("usual")).cast("long").alias("value"))
            .filter("value > 0")
        )
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
        return above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def audit_sources(
    docs: DataFrame, lang_column: str = "lang", source_column: str = "source",
    text_column: str = "text", least: int = LEAST,
) -> SourceAudit:
    """Kept terms and their shares in every source that occurs.

    Null languages, sources and texts count as ''. Every row is a document, repeated ids and
    texts too; texts of any length are read whole. Sources without kept terms stay, with no
    share; groups without kept terms have none at all. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(
        *[
            F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
            for c, name in ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))
        ]
    )
    terms = frequent_terms(rows.select("lang", "text"), least)
    counts = term_counts(rows.select("lang", "source", "text"), terms)
    kept = terms.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (
        rows.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .withColumns({"total": F.coalesce("total", zero), "terms": F.coalesce("terms", zero)})
        .withColumn("base", share(zero, F.col("total"), F.col("terms")))
        .withColumn(
            "number",
            F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1,
        )
    )
    groups = staged(groups, "groups")
    scaled = counts.join(groups.select("lang", "source", "total", "terms"), ["lang", "source"])
    shares = scaled.select(
        "lang", "source", "term", "count",
        share(F.col("count"), F.col("total"), F.col("terms")).alias("share"),
    )
    return SourceAudit(terms, groups, staged(shares, "shares"))
