"""Token ids as block files with Elias-Fano document boundaries.

A file set is a folder of Parquet rows. Each row is one block of whole documents: the token
ids of all of them back to back as little-endian unsigned integers of 2 or 4 bytes, the ids of
the documents, and their end positions as an Elias-Fano sequence whose select gives any
boundary from about ``2 + log2(ids / documents)`` bits per document. Spark's writer commits
the rows, so a task that is lost and run again leaves no half-written file.
"""

from __future__ import annotations

import json
import os
import re
import struct
import threading
import zlib
from collections.abc import Collection, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm.text import bound_batches, give_back, tidy

BLOCK_IDS = 1 << 20
BATCH_BYTES = 2 << 20  # of text that is encoded at once
KEPT_SECONDS = 2.0  # that an idle worker keeps its encoder
_HEADER = struct.Struct("<4sBIQ")
_MAGIC = b"EFB1"
_SUPER = 512  # bits of the upper part per entry of the select directory
_TWO_BLANKS = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]{2}"  # what Python's \s\s finds, for Arrow
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")  # letters by every version of Unicode
_WORD_START = re.compile(r"(?= \S)")


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space.

    The lower ``low_bits`` of each value are packed; the upper parts are a bit vector in which
    value ``i`` sets bit ``upper + i``. A directory holds the count of set bits before every
    512th bit in 32 bits, so ``select`` reads one stretch of 512 bits per request.
    """

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.count, self.low_bits, self.low, self.high = count, low_bits, low, high
        self.ranks = self._directory()

    def _directory(self) -> np.ndarray:
        ones = np.unpackbits(self.high, bitorder="little").reshape(-1, _SUPER).sum(1)
        return np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values`` are sorted and at most ``universe``."""
        values = values.astype(np.uint64)
        count = len(values)
        low_bits = max(0, int(universe // max(1, count)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        size = (int(universe) >> low_bits) + count + 1
        high = np.zeros(-(-size // _SUPER) * _SUPER, np.uint8)
        high[places] = 1
        return cls(count, low_bits, low, np.packbits(high, bitorder="little"))

    def to_bytes(self) -> bytes:
        head = _HEADER.pack(_MAGIC, self.low_bits, self.count, len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.ranks.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        magic, low_bits, count, n_high = _HEADER.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not an Elias-Fano block")
        at = _HEADER.size
        n_low = -(-count * low_bits // 8)
        self = cls.__new__(cls)
        self.count, self.low_bits = count, low_bits
        self.low = np.frombuffer(data, np.uint8, n_low, at)
        self.high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        self.ranks = np.frombuffer(data, "<u4", n_high * 8 // _SUPER + 1, at + n_low + n_high)
        return self

    def select(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``."""
        index = np.asarray(index, np.int64)
        block = np.searchsorted(self.ranks, index, side="right") - 1
        used, place = np.unique(block, return_inverse=True)
        width = _SUPER // 8
        bits = np.unpackbits(
            self.high.reshape(-1, width)[used], axis=1, bitorder="little"
        )
        ones_before = self.ranks[used].astype(np.int64)
        row, column = np.nonzero(bits)
        first = np.searchsorted(row, np.arange(len(used)))
        at = first[place] + index - ones_before[place]
        upper = used[place] * _SUPER + column[at] - index
        lower = np.zeros(len(index), np.int64)
        if self.low_bits:
            span = index[:, None] * self.low_bits + np.arange(self.low_bits)
            picked = (self.low[span >> 3] >> (span & 7).astype(np.uint8)) & 1
            lower = picked.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return (upper.astype(np.int64) << self.low_bits) | lower


class WordMemory:
    """Words in two generations of about ``limit`` entries: when the newer one is full it
    becomes the older, and words that are still in use come over from there."""

    def __init__(self, limit: int):
        self.limit = limit
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def missing(self, words: Collection[str]) -> list[str]:
        """The words, each given once, that neither generation has; the others are in ``now`` afterwards."""
        new = [w for w in words if w not in self.now]
        if len(self.now) + len(new) > self.limit:
            self.before, self.now, new = self.now, {}, list(words)
        self.now.update((w, self.before[w]) for w in new if w in self.before)
        return [w for w in new if w not in self.now]

    def known(self, word: str) -> bytes | None:
        found = self.now.get(word)
        return self.before.get(word) if found is None else found


class Encoder:
    """Whole texts to token ids through the tokenizers library, with a memory of words.

    A byte-level vocabulary never merges across a blank that a word follows, so a text may be
    cut there and each word encoded once. Arrow cuts the texts, numbers their words and lays out
    the ids; Python sees each distinct word of a batch once. Texts with neighbouring white space
    are cut before such blanks only. The names of special tokens are ordinary text or, if ``special``, the
    tokens themselves, as the library has it by default; texts with one go through it whole.
    """

    def __init__(self, path: str, limit: int = 300_000, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # words never hold special tokens
        self.special = []
        if special:
            added = self.tokenizer.get_added_tokens_decoder().values()
            self.special = [t.content for t in added if t.special]
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        [self.newline] = self._ids(["\n"])[0]
        self.heads, self.tails = WordMemory(limit), WordMemory(limit)
        self.marks: dict[str, bytes] = {}
        self.pieces = None
        kind = json.loads(self.tokenizer.to_str()).get("pre_tokenizer") or {}
        if kind.get("type") == "ByteLevel" and kind.get("use_regex"):
            self._know_letters(path)

    def _know_letters(self, path: str) -> None:
        """The expression of byte-level vocabularies keeps letters apart from all else. So a mark
        behind a letter has ids of its own, and words of letters alone, spelt in the signs that
        stand for bytes, need the library's model only, not its expression."""
        from tokenizers import Tokenizer, pre_tokenizers

        self.marks = {m: np.array(self._ids([m])[0], self.dtype).tobytes() for m in ",."}
        self.pieces = Tokenizer.from_file(path)
        self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {}
        for code in range(256):  # in UTF-8, a code from 128 is a lead and a further byte
            spelt = level.pre_tokenize_str(chr(code))[0][0]
            if code < 128:
                self.signs[code] = spelt
            else:
                self.signs[128 + code % 64] = spelt[1]
        for lead in range(0xC3, 0xCA):  # of the letters from À to ɏ
            self.signs[lead] = level.pre_tokenize_str(bytes([lead, 128]).decode())[0][0][0]
        self.signs[ord("\n")] = f" {self.signs[ord('\n')]} "

    def _learn(self, words: Collection[str], memory: WordMemory, prefix: str) -> None:
        new = dict.fromkeys(memory.missing(words))
        marked = [w for w in new if w[-1:] in self.marks and _LETTERS.fullmatch(w, len(w) - 2, len(w) - 1)]
        for w in marked:
            del new[w]
        new.update((w[:-1], None) for w in marked if memory.known(w[:-1]) is None)
        letters = [w for w in new if w.isalpha()]
        for kind in letters, [w for w in new if not w.isalpha()]:
            for i in range(0, len(kind), 20_000):
                part = kind[i : i + 20_000]
                memory.now.update(zip(part, self._encode_words(part, prefix), strict=True))
        memory.now.update((w, memory.known(w[:-1]) + self.marks[w[-1]]) for w in marked)

    def _encode_words(self, words: list[str], prefix: str) -> list[bytes]:
        """Words without white space go through the tokenizer as the lines of one text, whose
        line ends are tokens of their own; others one by one."""
        width = np.dtype(self.dtype).itemsize
        if "\n".join(words).split() == words:
            text = "".join(f"{prefix}{w}\n" for w in words)
            if self.pieces and _LETTERS.fullmatch("".join(words)):
                text = text.encode().decode("latin-1").translate(self.signs)
                [found] = self.pieces.encode_batch_fast([text], add_special_tokens=False)
                ids = np.array(found.ids, self.dtype)
            else:
                ids = np.array(self._ids([text])[0], self.dtype)
            ends = np.flatnonzero(ids == self.newline)
            if len(ends) == len(words):
                data = ids.tobytes()
                starts = [0, *((ends[:-1] + 1) * width).tolist()]
                return [data[a:b] for a, b in zip(starts, (ends * width).tolist(), strict=True)]
        return [np.array(ids, self.dtype).tobytes() for ids in self._ids([prefix + w for w in words])]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        """The ids of texts with the names of special tokens."""
        self.tokenizer.encode_special_tokens = False
        try:
            return [np.array(ids, self.dtype).tobytes() for ids in self._ids(texts)]
        finally:
            self.tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        return self.encode_column(pa.array(texts, pa.large_string()))

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as bytes; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        named = pa.array(np.zeros(len(texts), bool))
        for name in self.special:
            named = pc.or_(named, pc.match_substring(texts, name))
        spaced = pc.and_not(pc.match_substring_regex(texts, _TWO_BLANKS), named)
        out = self._plain(pc.if_else(pc.or_(named, spaced), "", texts))
        for rows, method in ((named, self._whole), (spaced, self._spaced)):
            places = np.flatnonzero(rows.to_numpy(zero_copy_only=False))
            if len(places):
                for place, ids in zip(places, method(texts.filter(rows).to_pylist()), strict=True):
                    out[place] = ids
        return out

    def _spaced(self, texts: list[str]) -> list[bytes]:
        """The ids of texts with neighbouring white space."""
        cut = [_WORD_START.split(text) for text in texts]
        self._learn({piece for pieces in cut for piece in pieces}, self.heads, "")
        return [b"".join(map(self.heads.now.__getitem__, pieces)) for pieces in cut]

    def _plain(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts without neighbouring white space. The words of a line follow a blank,
        which is part of their first token, but for the first one, its head."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        coded = lists.flatten().dictionary_encode()
        starts, number = lists.offsets.to_numpy(), coded.indices.to_numpy()
        words = coded.dictionary.to_numpy(zero_copy_only=False)  # far faster than to_pylist
        newline = pc.index(coded.dictionary, "\n").as_py()  # -1 if no text has one
        is_head = np.zeros(len(number) + 1, bool)
        is_head[starts[:-1]] = True
        is_head[np.flatnonzero(number == newline) + 1] = True
        is_head = is_head[:-1]
        used = np.zeros(len(words), bool)
        used[number[~is_head]] = True
        if newline >= 0:
            used[newline] = False
        tails, heads = np.flatnonzero(used), np.unique(number[is_head])
        entries = [np.array([self.newline], self.dtype).tobytes()]
        tail_place, head_place = np.zeros((2, len(words)), np.int64)  # a newline stays at 0
        for memory, prefix, chosen, place in (
            (self.tails, " ", tails, tail_place),
            (self.heads, "", heads, head_place),
        ):
            own = words[chosen].tolist()
            self._learn(own, memory, prefix)
            place[chosen] = len(entries) + np.arange(len(own))
            entries += map(memory.now.__getitem__, own)
        laid = pa.array(entries, pa.large_binary()).take(
            pa.array(np.where(is_head, head_place[number], tail_place[number]))
        )
        _, offsets, data = laid.buffers()
        ends = np.frombuffer(offsets, np.int64, len(laid) + 1)[starts].tolist()
        view = memoryview(data) if data is not None else b""
        return [bytes(view[a:b]) for a, b in zip(ends, ends[1:])]


_ENCODERS: dict[str, Encoder] = {}
_FORGETS: dict[str, threading.Timer] = {}


def _forget(path: str) -> None:
    _ENCODERS.pop(path, None)
    give_back()


@contextmanager
def encoder(path: str) -> Iterator[Encoder]:
    """One encoder per Python worker, so that its memory outlives a task.

    Spark keeps idle workers and hands them other work, beside which the memory would stay. So
    it goes when no task has asked for it for a while.
    """
    if path in _FORGETS:
        _FORGETS.pop(path).cancel()
    own = _ENCODERS.get(path) or Encoder(path, special=True)
    _ENCODERS[path] = own
    try:
        yield own
    finally:
        _FORGETS[path] = threading.Timer(KEPT_SECONDS, _forget, (path,))
        _FORGETS[path].daemon = True
        _FORGETS[path].start()


def bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with up to ``BATCH_BYTES`` of text (column 1), or single longer rows."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def _packed(tokenizer_path: str, end_id: int, block_ids: int, id_type: pa.DataType, schema):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(tokenizer_path) as own:
            yield from blocks(own, batches)

    def blocks(own: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], own.dtype).tobytes()
        width = np.dtype(own.dtype).itemsize
        part = TaskContext.get().partitionId()
        number, start, held, names, lengths = 0, 0, [], [], []

        def block():
            ends = np.cumsum(lengths)
            boundaries = EliasFano.encode(ends, int(ends[-1]))
            row = [part, number, start, len(names), int(ends[-1]), width]
            row += [b"".join(held), boundaries.to_bytes(), names]
            columns = [pa.array([v], f.type) for v, f in zip(row, schema, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=schema), int(ends[-1])

        for batch in batches:
            for piece in bounded(batch):
                ids = own.encode_column(piece.column(1))
                for name, data in zip(piece.column(0).to_pylist(), ids, strict=True):
                    held += [data, end]
                    names.append(name)
                    lengths.append(len(data) // width + 1)
                if sum(lengths) >= block_ids:
                    made, size = block()
                    yield made
                    give_back()
                    number, start, held, names, lengths = number + 1, start + size, [], [], []
        if names:
            yield block()[0]

    return pack


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode whole texts in ascending id order and write blocks and a list of parts.

    A null or empty text holds the end id alone; null ids come first; rows that repeat an id
    follow each other in the order of their texts. The texts are dealt out by ranges of id, so
    the parts are in order; only one row per part (its ids and documents) goes to the list.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    ordered = (
        rows.withColumn("h", F.xxhash64("text"))
        .repartitionByRange(parts, "doc_id", "h")
        .sortWithinPartitions("doc_id", "h", "text")
        .select("doc_id", "text")
    )
    id_ddl = dict(rows.dtypes)["doc_id"]
    id_type = pa.string() if id_ddl == "string" else pa.int32() if id_ddl == "int" else pa.int64()
    schema = pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("part_start", pa.int64())]
        + [("n_docs", pa.int32()), ("n_ids", pa.int64()), ("width", pa.int32())]
        + [("ids", pa.binary()), ("ends", pa.binary()), ("doc_ids", pa.list_(id_type))]
    )
    ddl = (
        "part int, block int, part_start long, n_docs int, n_ids long, width int, "
        f"ids binary, ends binary, doc_ids array<{id_ddl}>"
    )
    packed = ordered.mapInArrow(
        tidy(_packed(tokenizer_path, end_id, block_ids, id_type, schema)), ddl
    )
    packed.write.parquet(f"{path}/blocks")
    totals = (
        spark.read.parquet(f"{path}/blocks")
        .groupBy("part")
        .agg(F.sum("n_ids").alias("n_ids"), F.sum("n_docs").alias("n_docs"))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).coalesce(
        1
    ).write.parquet(f"{path}/parts")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, ids (bytes).

    ``start`` counts the ids of all documents before; ``ids`` are unsigned 32-bit
    little-endian, and so is what the checksum covers.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    id_ddl = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    # one row per part of the file set, however many documents there are
    parts = F.broadcast(spark.read.parquet(f"{path}/parts").select("part", "start"))
    rows = blocks.join(parts, "part").select(
        (F.col("start") + F.col("part_start")).alias("start"), "width", "ids", "ends", "doc_ids"
    )
    id_type = blocks.limit(0).select("doc_ids").toArrow().schema.field(0).type.value_type

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, width, ids, ends, names = (c[row].as_py() for c in batch.columns)
                sequence = EliasFano.from_bytes(ends)
                stops = sequence.select(np.arange(sequence.count))
                starts = np.concatenate([[0], stops[:-1]])
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
                pieces = [wide[4 * a : 4 * b] for a, b in zip(starts, stops, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, id_type),
                        pa.array(starts + start, pa.int64()),
                        pa.array(stops - starts, pa.int64()),
                        pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                        pa.array(pieces, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    ddl = f"doc_id {id_ddl}, start long, n_tokens long, ids_crc32 long, ids binary"
    return rows.mapInArrow(tidy(unpack), ddl)
