"""A toxicity classifier: gradient-boosted trees over a few dense features of the text.

The lexicon is learned from the labelled rows: words and word beginnings that far more toxic
than clean documents hold. Features are the densities of its hits, in the whole text, in the
densest window, next to a second person and behind disguised spelling, and the rates of
capitals, punctuation, digits and drawn-out letters. Trees are fitted to the logistic loss;
an isotonic curve over rows the trees have not seen makes their sum a probability.

Rows are dealt into folds: the features of a labelled row come from the lexicon of the other
folds, the margins under the isotonic curve from trees of the other folds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.text import bound_batches, raw, with_results
from ledgermill.session import staged

TRAINING_ROWS = 12_000  # bound of the labelled sample that the model is fitted on
THRESHOLD = 0.5
FOLDS = 5
STEM_SIZES = range(3, 9)  # characters of word beginnings
LEAST_TOXIC = 5  # toxic documents a lexicon entry occurs in
LEAST_RATIO = 15.0  # its log-likelihood ratio: one in 10,000 by chance
LEAST_WEIGHT = 1.0  # its log-odds
WINDOW = 50  # words of the densest window
NEAR = 5  # words between a hit and a second person
REMEMBERED = 200_000  # words whose weight a task keeps

# Words that address the reader, in English, German, French, Spanish, Italian
# and Portuguese.
SECOND_PERSON = frozenset(
    w.encode()
    for w in (
        "you your yours yourself yourselves u ur "
        "du dich dir dein deine deinen deinem deiner deines ihr euch euer eure "
        "tu te toi ton ta tes vous votre vos "
        "tú ti tus tuyo usted ustedes vosotros vuestro vuestra "
        "tuo tua tuoi voi vostro "
        "você vocês teu"
    ).split()
)
# Signs that stand for letters in disguised spelling.
_DISGUISE = bytes.maketrans(b"01345789@$!|+", b"oieastbgasiit")
_DISGUISED = re.compile(rb"(?<![^\s])[\"'(]*[a-z\x80-\xff@$][a-z\x80-\xff]*(?:[0-9@$!|+*._-]+[a-z\x80-\xff]+)+")
_FILLER = re.compile(rb"[*._\-\"'()]+")
_LETTERS = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 32 for c in range(256))
_DRAWN = re.compile(rb"([a-z])\1\1")
_CAPITALS = re.compile(rb"\b[A-Z]{2,}\b")
_UPPER, _DIGITS = bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A))
_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "!?")

NAMES = (
    "words", "hit_density", "hit_weight", "heaviest", "hits", "kinds", "densest", "person_density",
    "near_density", "near_hits", "capitals", "shouted", "exclamations", "questions", "marks",
    "disguised", "disguised_hits", "drawn_out", "digits",
)


def words_of(lowered: bytes) -> list[bytes]:
    return lowered.translate(_LETTERS).split()


def stems_of(word: bytes) -> list[bytes]:
    """The word, marked as whole, and its beginnings."""
    text = word.decode(errors="replace")
    return [word + b" ", *[text[:n].encode() for n in STEM_SIZES if n <= len(text)]]


def _lowered(text: bytes) -> bytes:
    return text.decode(errors="replace").lower().encode()


def weights(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-odds of entries by the documents that hold them; 0 for those not beyond chance."""
    p, q = (toxic + 0.5) / (n_toxic + 1), (clean + 0.5) / (n_clean + 1)
    odds = np.log(p / (1 - p + 1e-9)) - np.log(q / (1 - q + 1e-9))
    share = (toxic + clean) / max(1, n_toxic + n_clean)

    def likely(k, n, s):
        s = np.clip(s, 1e-12, 1 - 1e-12)
        return k * np.log(s) + (n - k) * np.log(1 - s)

    ratio = 2 * (
        likely(toxic, n_toxic, toxic / max(1, n_toxic)) - likely(toxic, n_toxic, share)
        + likely(clean, n_clean, clean / max(1, n_clean)) - likely(clean, n_clean, share)
    )
    kept = (toxic >= LEAST_TOXIC) & (ratio >= LEAST_RATIO) & (odds >= LEAST_WEIGHT)
    return np.where(kept, odds, 0.0)


class Features:
    """The dense features of texts under a lexicon: entry to weight."""

    def __init__(self, lexicon: dict[bytes, float]):
        self.lexicon = lexicon
        self.known: dict[bytes, float] = {}

    def weight(self, word: bytes) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = max([0.0, *[self.lexicon[s] for s in stems_of(word) if s in self.lexicon]])
            if len(word) <= 100:
                self.known[word] = found
        return found

    def of(self, text: bytes) -> list[float]:
        lowered = _lowered(text)
        words = words_of(lowered)
        n, size = max(1, len(words)), max(1, len(text))
        values = [self.weight(w) for w in words]
        at = [i for i, v in enumerate(values) if v]
        person = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        near = 0
        if at and person:
            gaps = np.searchsorted(person, at)
            person_at = np.array([-(10**9), *person, 10**9])
            places = np.array(at)
            near = int(np.count_nonzero(
                np.minimum(places - person_at[gaps], person_at[gaps + 1] - places) <= NEAR
            ))
        densest = 0
        if at:
            starts = np.array(at)
            densest = int((np.searchsorted(starts, starts + WINDOW) - np.arange(len(at))).max())
        odd = _DISGUISED.findall(lowered)
        odd_hits = 0
        for token in odd:
            plain = _FILLER.sub(b"", token).translate(_DISGUISE)
            odd_hits += any(self.weight(w) for w in words_of(plain))
        heavy = sum(values)
        return [
            np.log1p(len(words)), len(at) / n, heavy / n, max(values, default=0.0), np.log1p(len(at)),
            np.log1p(len({words[i] for i in at})), densest / min(n, WINDOW), len(person) / n,
            near / n, np.log1p(near), (len(text) - len(text.translate(None, _UPPER))) / size,
            len(_CAPITALS.findall(text)) / n, text.count(b"!") / n, text.count(b"?") / n,
            (len(text) - len(text.translate(None, _MARKS))) / size, len(odd) / n, odd_hits / n,
            len(_DRAWN.findall(lowered)) / n, (len(text) - len(text.translate(None, _DIGITS))) / size,
        ]

    def table(self, texts: Iterable[bytes]) -> np.ndarray:
        rows = [self.of(t) for t in texts]
        return np.array(rows, np.float64).reshape(len(rows), len(NAMES))


@dataclass
class Trees:
    """Boosted trees of one depth: per tree and inner node a feature and a cut, per leaf a value."""

    depth: int
    base: float
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray
    leaves: np.ndarray  # trees x 2 ** depth

    def margin(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (rows[every, features[node]] > cuts[node])
            total += leaves[node - (2**self.depth - 1)]
        return total


def fit_trees(
    rows: np.ndarray, labels: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15,
    bins: int = 48, least: float = 3.0, ridge: float = 1.0,
) -> Trees:
    """Newton boosting on the logistic loss; cuts are taken at quantiles of each feature.

    A split needs ``least`` rows on both sides.
    """
    n, width = rows.shape
    inner = 2**depth - 1
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
             for f in range(width)]
    slots = np.stack([np.searchsorted(edges[f], rows[:, f], side="left") for f in range(width)], 1)
    most = max(len(e) for e in edges) + 1
    rate_of = (labels.sum() + 1) / (n + 2)
    base = float(np.log(rate_of / (1 - rate_of)))
    margin = np.full(n, base)
    made: tuple[list, list, list] = ([], [], [])
    flat = slots + np.arange(width) * most
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        slope, curve = labels - p, np.maximum(p * (1 - p), 1e-6)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for at in range(inner):
            mine = np.flatnonzero(node == at)
            best = (1e-6, -1, -1)
            if len(mine) >= 2 * least:
                keys = flat[mine].ravel()
                sums = [
                    np.bincount(keys, np.repeat(v, width), width * most).reshape(width, most).cumsum(1)
                    for v in (slope[mine], curve[mine], np.ones(len(mine)))
                ]
                g, h, c = (s[:, :-1] for s in sums)
                all_g, all_h, all_c = (s[:1, -1:] for s in sums)
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge)
                gain = gain - all_g**2 / (all_h + ridge)
                gain[(c < least) | (all_c - c < least)] = -1
                feature, cut = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[feature, cut] > best[0] and cut < len(edges[feature]):
                    best = (gain[feature, cut], int(feature), int(cut))
            if best[1] >= 0:
                features[at], cuts[at] = best[1], edges[best[1]][best[2]]
            node[mine] = 2 * at + 1 + (rows[mine, features[at]] > cuts[at])
        leaf = node - inner
        g = np.bincount(leaf, slope, inner + 1)
        h = np.bincount(leaf, curve, inner + 1)
        values = rate * np.clip(g / (h + ridge), -4, 4)
        margin += values[leaf]
        for part, value in zip(made, (features, cuts, values), strict=True):
            part.append(value)
    return Trees(depth, base, *map(np.array, made))


@dataclass
class Isotonic:
    """A rising curve through the means of blocks of margins, straight between their centres."""

    at: np.ndarray
    value: np.ndarray

    @classmethod
    def fit(cls, margins: np.ndarray, labels: np.ndarray) -> Isotonic:
        order = np.argsort(margins, kind="stable")
        blocks: list[list[float]] = []  # weight, sum of labels, sum of margins
        points, first, sizes = np.unique(margins[order], return_index=True, return_counts=True)
        for x, start, size in zip(points, first, sizes, strict=True):
            blocks.append([size, float(labels[order[start : start + size]].sum()), x * size])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
        sizes, sums, centres = np.array(blocks).T
        return cls(centres / sizes, (sums + 0.5 * labels.mean()) / (sizes + 0.5))

    def of(self, margins: np.ndarray) -> np.ndarray:
        return np.interp(margins, self.at, np.maximum.accumulate(self.value))


@dataclass
class Model:
    lexicon: dict[bytes, float]
    trees: Trees | None
    curve: Isotonic | None
    share: float = 0.5  # the score where there are no trees

    def scores(self, features: Features, texts: Iterable[bytes]) -> np.ndarray:
        table = features.table(texts)
        if self.trees is None or self.curve is None:
            return np.full(len(table), self.share)
        return np.clip(self.curve.of(self.trees.margin(table)), 0.0, 1.0)


def labelled_rows(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, bound: int
) -> DataFrame:
    """(text, label, fold) of at most ``bound`` labelled ids, chosen by a hash of the id."""
    agreed = (
        labels.groupBy(F.col(id_column).alias("id"))
        .agg(F.min(label_column).alias("low"), F.max(label_column).alias("high"))
        .filter("id is not null and low = high and low in (0, 1)")
        .withColumn("place", F.md5(F.col("id").cast("string")))
    )
    chosen = agreed.orderBy("place", "id").limit(bound).select(
        "id", F.col("low").cast("int").alias("label"), F.pmod(F.conv(F.substring("place", 1, 8), 16, 10)
        .cast("long"), F.lit(FOLDS)).cast("int").alias("fold"),
    )
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = texts.join(F.broadcast(chosen), "id")  # ``bound`` rows of three numbers
    return staged(found.drop("id"), "labelled")


def learn_lexicons(rows: DataFrame) -> tuple[list[dict[bytes, float]], np.ndarray]:
    """The lexicon without each fold, last the one of all rows; and the rows by (fold, label)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(2 * FOLDS)]

        def handed_on() -> pa.RecordBatch:
            entries = [s for c in counts for s in c]
            numbers = [n for c in counts for n in c.values()]
            cells = [i for i, c in enumerate(counts) for _ in range(len(c))]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(entries, pa.binary()), pa.array(cells, pa.int32()), pa.array(numbers, pa.int64())],
                names=["entry", "cell", "docs"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                cells = zip(part.column(2).to_pylist(), part.column(1).to_pylist(), strict=True)
                for text, (fold, label) in zip(raw(part.column(0)), cells, strict=True):
                    held = {s for w in set(words_of(_lowered(text))) for s in stems_of(w)}
                    counts[2 * fold + label].update(held)
                if sum(map(len, counts)) > 500_000:
                    yield handed_on()
        yield handed_on()

    spread = rows.select("text", "label", "fold")
    cells = [F.sum(F.when(F.col("cell") == i, F.col("docs")).otherwise(0)).alias(f"c{i}") for i in range(2 * FOLDS)]
    toxic = sum((F.col(f"c{2 * f + 1}") for f in range(FOLDS)), F.lit(0))
    clean = sum((F.col(f"c{2 * f}") for f in range(FOLDS)), F.lit(0))
    sizes = np.zeros((FOLDS, 2), np.int64)
    for fold, label, n in rows.groupBy("fold", "label").count().collect():  # ten rows
        sizes[fold, label] = n
    n_clean, n_toxic = sizes.sum(0)
    found = (
        spread.mapInArrow(count, "entry binary, cell int, docs long")
        .groupBy("entry").agg(*cells)
        .filter((toxic >= LEAST_TOXIC) & (toxic * int(n_clean) > 2 * clean * int(n_toxic)))
        .toArrow()
    )
    entries = found.column("entry").to_pylist()
    table = np.array([found.column(f"c{i}").to_numpy() for i in range(2 * FOLDS)]).reshape(FOLDS, 2, -1)
    lexicons = []
    for without in [*range(FOLDS), None]:
        kept = [f for f in range(FOLDS) if f != without]
        clean_docs, toxic_docs = table[kept].sum(0)
        found_weights = weights(toxic_docs, clean_docs, sizes[kept, 1].sum(), sizes[kept, 0].sum())
        lexicons.append({e: float(w) for e, w in zip(entries, found_weights, strict=True) if w > 0})
    return lexicons, sizes


def fit(rows: DataFrame) -> Model:
    """A model of ``rows`` (text, label, fold); one class only gives its smoothed share."""
    lexicons, sizes = learn_lexicons(rows)
    n_clean, n_toxic = sizes.sum(0)
    if not n_clean or not n_toxic:
        return Model({}, None, None, float((n_toxic + 1) / (n_clean + n_toxic + 2)))
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_fold = [Features(lexicon) for lexicon in shared.value]
        for batch in batches:
            found = [
                by_fold[fold].of(text)
                for at in range(0, batch.num_rows, 200)
                for text, fold in zip(
                    raw(batch.column(0).slice(at, 200)), batch.column(2).slice(at, 200).to_pylist(), strict=True
                )
            ]
            values = pa.array([list(map(float, f)) for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, batch.column(1), batch.column(2)], names=["x", "label", "fold"])

    made = rows.select("text", "label", "fold").mapInArrow(describe, "x array<double>, label int, fold int")
    made = made.orderBy("fold", "label", "x").toArrow()  # bounded rows of a few numbers
    shared.destroy()
    table = np.array(made.column("x").to_pylist(), np.float64)
    labels = made.column("label").to_numpy().astype(np.float64)
    folds = made.column("fold").to_numpy()
    margins = np.zeros(len(labels))
    for fold in range(FOLDS):
        unseen = folds == fold
        seen = ~unseen if len(set(labels[~unseen])) == 2 else np.ones(len(labels), bool)
        if unseen.any():
            margins[unseen] = fit_trees(table[seen], labels[seen]).margin(table[unseen])
    return Model(lexicons[-1], fit_trees(table, labels), Isotonic.fit(margins, labels))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", threshold: float = THRESHOLD, bound: int = TRAINING_ROWS,
) -> DataFrame:
    """``docs`` plus score (0 to 1, higher: label 1 is likelier) and predicted (1 or 0).

    The model is fitted on the documents of at most ``bound`` ids that ``labels`` marks 0 or 1;
    ids with differing labels and null ids or labels are left out. Every row gets a score from
    its whole text alone, rows with equal texts the same; null counts as empty. Without labels
    all scores are 0.5. Columns named like results are replaced.
    """
    bound_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(
        fit(labelled_rows(docs, labels, id_column, text_column, label_column, bound))
    )
    features: list[Features] = []

    def score(array: pa.Array) -> pa.Array:
        if not features:  # one per Python worker and query
            features.append(Features(model.value.lexicon))
        found = [
            model.value.scores(features[0], raw(array.slice(at, 500))) for at in range(0, len(array), 500)
        ]
        scores = np.concatenate(found) if found else np.empty(0)
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64())], names=["score"])

    scored = with_results(docs, [text_column], score, "score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
