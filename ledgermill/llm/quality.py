"""A quality classifier: a linear support vector machine on naive Bayes features.

Texts become indicators of n-grams: words and word pairs, and one to three neighbouring word
shapes (``The!!`` has the shape ``Aa!``). Each indicator is scaled by the log ratio of its
smoothed counts in the two classes, rows have length one, and a hinge loss is fitted by dual
coordinate descent. The margin becomes a probability by a logistic curve that is fitted on
rows the machine has not seen.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.text import ngram_hashes, raw, with_results, word_hashes

DIMENSION_BITS = 18
TRAINING_ROWS = 8_000  # bound of the labelled sample that the model is fitted on
THRESHOLD = 0.3
_SHAPE = bytes(
    0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A or c >= 0x80
    else 0x30 if 0x30 <= c <= 0x39 else c for c in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)


def features_of(text: bytes) -> np.ndarray:
    """The sorted distinct feature numbers of a text; feature 0 is the constant."""
    plain = word_hashes(text.split())
    shapes = word_hashes(_RUN.sub(rb"\1", text.translate(_SHAPE)).split())
    grams = [plain, ngram_hashes(plain, 2)]
    grams += [np.unique(ngram_hashes(shapes, n)) for n in (1, 2, 3)]
    found = np.concatenate(grams) >> np.uint64(64 - DIMENSION_BITS)
    present = np.zeros(1 << DIMENSION_BITS, bool) if len(found) > 50_000 else None
    if present is None:
        return np.unique(np.append(found, np.uint64(0))).astype(np.int32)
    present[found.astype(np.int64)] = True
    present[0] = True
    return np.flatnonzero(present).astype(np.int32)


@dataclass
class Model:
    scale: np.ndarray  # log-count ratios
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, features: np.ndarray) -> float:
        x = self.scale[features]
        return float(self.weights[features] @ x) / (float(np.sqrt(x @ x)) or 1.0)

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features) + self.offset, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.ones((2, 1 << DIMENSION_BITS))
    for features, label in zip(rows, labels, strict=True):
        counts[label, features] += 1
    shares = counts / (np.bincount(labels, minlength=2)[:, None] + 2)
    ratios = np.log(shares[1] / shares[0])
    ratios[0] = 1.0  # the constant
    return ratios


def dual_coordinate_descent(
    rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float = 1.0,
    rounds: int = 12, seed: int = 0,
) -> np.ndarray:
    """Weights of the machine with hinge loss: one dual variable at a time, in seeded order."""
    signs = np.where(labels == 1, 1.0, -1.0)
    values = []
    for features in rows:
        x = scale[features]
        values.append(x / (np.sqrt(x @ x) or 1.0))
    weights, dual = np.zeros(len(scale)), np.zeros(len(rows))
    generator = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in generator.permutation(len(rows)):
            features, x = rows[i], values[i]
            gradient = signs[i] * (weights[features] @ x) - 1
            new = min(max(dual[i] - gradient, 0.0), cost)  # the rows have length one
            if new != dual[i]:
                weights[features] += (new - dual[i]) * signs[i] * x
                worst = max(worst, abs(new - dual[i]))
                dual[i] = new
        if worst < 1e-3:
            break
    return weights


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps on targets kept away from 0 and 1."""
    good, bad = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    inputs = np.stack([margins, np.ones(len(margins))], 1)
    at = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(inputs @ at, -500, 500)))
        slope = inputs.T @ (p - target) + 1e-6 * at
        curve = (inputs * (p * (1 - p))[:, None]).T @ inputs + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at -= step * min(1.0, 5.0 / (np.abs(step).max() or 1.0))
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model from labelled rows; one class only gives a constant score of that class."""
    classes = set(labels.tolist())
    if len(classes) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        empty = np.zeros(1 << DIMENSION_BITS)
        return Model(empty, empty, 1.0, float(np.log(share / (1 - share))))
    seen = np.arange(len(rows)) % 4 != 3
    if len(set(labels[seen].tolist())) < 2 or len(set(labels[~seen].tolist())) < 2:
        seen = np.ones(len(rows), bool)
    scale = log_count_ratios([rows[i] for i in np.flatnonzero(seen)], labels[seen])
    model = Model(
        scale,
        dual_coordinate_descent([rows[i] for i in np.flatnonzero(seen)], labels[seen], scale),
    )
    unseen = np.flatnonzero(~seen) if not seen.all() else np.flatnonzero(seen)
    margins = np.array([model.margin(rows[i]) for i in unseen])
    model.slope, model.offset = logistic_curve(margins, labels[unseen])
    return model


def training_rows(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str,
    bound: int,
) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of at most ``bound`` labelled rows, chosen by a hash of the id."""
    agreed = (
        labels.groupBy(F.col(id_column).alias("__id"))
        .agg(F.min(label_column).alias("__low"), F.max(label_column).alias("__high"))
        .filter("__id is not null and __low = __high and __low in (0, 1)")
        .select("__id", F.col("__low").cast("int").alias("__label"))
    )
    chosen = agreed.orderBy(F.md5(F.col("__id").cast("string")), "__id").limit(bound)
    texts = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text"))

    def extract(array: pa.Array) -> pa.Array:
        return pa.array([features_of(t) for t in raw(array)], pa.list_(pa.int32()))

    udf = F.arrow_udf(extract, returnType="array<int>")
    # ``bound`` rows of an id and a label
    picked = texts.join(F.broadcast(chosen), "__id").select(
        "__id", "__label", udf("__text").alias("features")
    )
    rows = (  # repeated ids can be many rows; the bound holds for them too
        picked.orderBy(F.md5(F.col("__id").cast("string")), "__id", "features")
        .limit(bound)
        .toArrow()
    )
    found = rows.column("features").combine_chunks()
    if isinstance(found, pa.ChunkedArray):
        found = pa.concat_arrays(found.chunks) if found.num_chunks else pa.array([], found.type)
    features = [np.asarray(found[i].values) for i in range(len(found))]
    return features, np.array(rows.column("__label").to_pylist(), np.int64)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", threshold: float = THRESHOLD, bound: int = TRAINING_ROWS,
) -> DataFrame:
    """``docs`` plus score (0 to 1, higher: label 1 is likelier) and predicted (1 or 0).

    The model is fitted on at most ``bound`` documents that ``labels`` marks 0 or 1; ids with
    differing labels and null ids or labels are left out. Every row gets a score from its
    whole text alone; null counts as empty; an empty text has the constant feature only.
    Without labels all scores are 0.5. Columns named like results are replaced.
    """
    rows, marks = training_rows(docs, labels, id_column, text_column, label_column, bound)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, marks))

    def score(array: pa.Array) -> pa.Array:
        scores = [
            model.value.score(features_of(t))
            for at in range(0, len(array), 500)
            for t in raw(array.slice(at, 500))
        ]
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64())], names=["score"]
        )

    scored = with_results(docs, [text_column], score, "score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
