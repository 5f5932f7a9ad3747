"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton names every vocabulary piece that ends at each character; dynamic
programming keeps, per position, the best score, the number of pieces on the way there and
whether the last one is unknown. Nothing else of the path is kept.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.text import with_results

UNKNOWN_PENALTY = 10.0  # an unknown character scores the lowest piece less this
# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
)
WORD = re.compile(f"[^{WHITE_SPACE}]+")
WORD_START = "▁"
UNKNOWN_UNIT = 1 << 40  # above the pieces of any one text; Python's integers do not overflow


def sentencepiece_vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece model with their scores; number 0 is the unknown one."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class CountOnlyViterbi:
    """Counts pieces of single words with the tokenizer's tie rules.

    Scores add up from the left in double precision. Of paths with equal scores the first one
    found stays: candidates for a position come in order of their start, so the longest last
    piece wins. Neighbouring unknown characters are one piece.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int = 0):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for number, (piece, score) in enumerate(vocabulary):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, number == unknown))
        self.automaton.make_automaton()
        self.unknown_score = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY

    def count(self, word: str) -> tuple[int, int]:
        """(pieces, of them unknown)."""
        return unpacked(self.packed_count(word))

    def packed_count(self, word: str) -> int:
        """Pieces plus ``UNKNOWN_UNIT`` times the unknown ones.

        The automaton names the pieces that end at a character from the longest to the
        shortest, so they are used as they come.
        """
        size = len(word)
        scores, counts, is_unknown = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)

        def try_unknown(end: int, best: float, score: float, length: int = 1) -> float:
            start = end - length
            total = scores[start] + score
            if total > best:
                scores[end] = best = total
                counts[end] = counts[start] + (not is_unknown[start]) * (1 + UNKNOWN_UNIT)
                is_unknown[end] = True
            return best

        worst = float("-inf")
        end, best, has_single = 0, 0.0, True
        for last, (length, score, unknown) in self.automaton.iter(word):
            if last >= end:
                if not has_single:
                    try_unknown(end, best, self.unknown_score)
                for skipped in range(end + 1, last + 1):
                    try_unknown(skipped, worst, self.unknown_score)
                end, best, has_single = last + 1, worst, False
            if length == 1:
                has_single = True
            if unknown:
                best = try_unknown(end, best, score, length)
                continue
            start = end - length
            total = scores[start] + score
            if total > best:
                scores[end] = best = total
                counts[end] = counts[start] + 1
                is_unknown[end] = False
        if not has_single:
            try_unknown(end, best, self.unknown_score)
        for skipped in range(end + 1, size + 1):
            try_unknown(skipped, worst, self.unknown_score)
        return counts[size]


def unpacked(packed: int) -> tuple[int, int]:
    """(pieces, of them unknown); sums of packed counts unpack to the sums of both."""
    return packed % UNKNOWN_UNIT, packed // UNKNOWN_UNIT


class WordCounts(dict):
    """Packed counts per word, kept between batches in two generations of ``limit`` words: when
    the newer one is full it becomes the older, and words still in use come over from there."""

    def __init__(self, viterbi: CountOnlyViterbi, limit: int = 300_000):
        super().__init__()
        self.viterbi, self.limit = viterbi, limit
        self.before: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        value = self.before.get(word)
        if value is None:
            value = self.viterbi.packed_count(WORD_START + word)
        self[word] = value
        return value


_COUNTERS: dict[str, WordCounts] = {}


def _counter(path: str) -> WordCounts:
    if path not in _COUNTERS:
        _COUNTERS[path] = WordCounts(CountOnlyViterbi(sentencepiece_vocabulary(path)))
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary_path: str, text_column: str = "text") -> DataFrame:
    """``docs`` plus n_tokens, n_unknown and n_words of the whole text.

    Texts are cut at white space and each word starts with the word mark, as the tokenizer's
    pre-tokenizer does. Null and empty texts count 0; rows are independent of each other;
    columns named like results are replaced. ``vocabulary_path`` names a sentencepiece model
    that every executor can open; its pieces and scores are read as a unigram vocabulary.
    """
    name = os.fspath(vocabulary_path)

    def count(array: pa.Array) -> pa.Array:
        counter = _counter(name)
        totals, unknowns, words = [], [], []
        for text in array.to_pylist():
            found = WORD.findall(text or "")
            pieces, unknown = unpacked(sum(map(counter.__getitem__, found)))
            totals.append(pieces)
            unknowns.append(unknown)
            words.append(len(found))
        return pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (totals, unknowns, words)],
            names=["n_tokens", "n_unknown", "n_words"],
        )

    return with_results(
        docs, [text_column], count, "n_tokens long, n_unknown long, n_words long"
    )
