"""Language of a text: averaged hashed subword embeddings with a linear softmax.

The features of a text are the character 2- to 4-grams of its lower-cased words, with a
mark at both ends of a word, hashed to a fixed number of buckets.  Training averages the
embeddings of a text's grams and fits them and the softmax by stochastic gradient descent
in numpy, on a bounded sample of labelled rows.  A temperature fitted on rows held back
from that sample calibrates the probabilities.  Two thresholds mark predictions to reject:
of the odds, from the rows held back, and of the familiarity of the text, from all rows.
That is the mean log frequency of its grams in the other training rows of the language
predicted; a softmax alone is often sure of letter junk and of languages it never saw.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
DIMENSIONS = 16
# Bound of the training sample: rows of one language.
ROWS_PER_LANGUAGE = 500
# Rows looked through for each that is drawn.
MARGIN = 2
# Letters of a text worked on at once.
PIECE_LETTERS = 1 << 18
EPOCHS = 6
LEARNING_RATE = 2.0
CALIBRATION_SHARE = 0.25
# Share of rightly labelled calibration rows that each rejection threshold may cost.
REJECTED_SHARE = 0.001
SEED = 17


@dataclass
class LanguageModel:
    """Per-bucket language scores (embedding times softmax weights), and calibration.

    ``table`` holds a score and a log frequency per bucket and language, side by side.
    """

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least_odds: float
    least_familiarity: float


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _marked(text: str) -> np.ndarray:
    """Code points of the lower-cased words, with one 0 before, between and after them."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one mark after each word
    marked = np.where(letter, points, 0)[keep]
    return np.concatenate([np.zeros(1, np.uint32), marked, np.zeros(1, np.uint32)])


def _piece_buckets(c: np.ndarray, starts: int) -> np.ndarray:
    """Buckets of the grams that start at the first ``starts`` places of ``c``."""
    found = []
    rolled = c.copy()
    for n in range(2, max(ORDERS) + 1):
        rolled = rolled[:-1] * np.uint32(0x01000193) ^ c[n - 1 :]
        if n in ORDERS:
            whole = np.arange(len(rolled)) < starts
            for i in range(1, n - 1):
                whole &= c[i : len(rolled) + i] != 0
            if n == 2:
                whole &= (c[:-1] != 0) | (c[1:] != 0)
            mixed = (rolled[whole] + np.uint32(n)) * np.uint32(0x9E3779B1)
            found.append((mixed ^ mixed >> np.uint32(15)) * np.uint32(0x85EBCA77) >> np.uint32(16))
    return np.concatenate(found)


def gram_buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket of every gram of the whole text, repeats included, piece by piece."""
    c = _marked(text)
    for start in range(0, len(c), PIECE_LETTERS):
        yield _piece_buckets(c[start : start + PIECE_LETTERS + max(ORDERS) - 1], PIECE_LETTERS)


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a training text and their counts."""
    total = sum(np.bincount(piece, minlength=BUCKETS) for piece in gram_buckets(text))
    buckets = np.flatnonzero(total)
    return buckets.astype(np.int32), total[buckets].astype(np.int32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _log_odds(logits: np.ndarray, best: int) -> float:
    """Log odds of one language against all others, exact where its chance rounds to one."""
    rest = np.delete(logits, best)
    if not len(rest):
        return np.inf
    return float(logits[best] - rest.max() - np.log(np.exp(rest - rest.max()).sum()))


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log likelihood."""
    own = np.arange(len(labels))
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 61))
    losses = [-np.log(_softmax(logits / t)[own, labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def _mean(table: np.ndarray, row: tuple[str, np.ndarray, np.ndarray]) -> np.ndarray:
    """Mean of the table rows of a text's grams."""
    return row[2] / row[2].sum() @ table[row[1]]


def _familiarity(seen: np.ndarray, row: tuple[str, np.ndarray, np.ndarray], own: bool) -> float:
    """Mean log frequency of a row's grams, without the row itself if it is among them."""
    _, buckets, counts = row
    times, total = seen[buckets], seen.sum()
    if own:
        times, total = times - counts, total - counts.sum()
    return float(counts / counts.sum() @ np.log(times / total))


def _low_end(values: np.ndarray) -> float:
    """What all but REJECTED_SHARE of such values reach.

    Few values say nothing about a share that small, so the tail of a normal distribution
    with their mean and deviation is taken where it lies lower.
    """
    tail = values.mean() + NormalDist().inv_cdf(REJECTED_SHARE) * values.std()
    return float(min(np.quantile(values, REJECTED_SHARE), tail))


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> LanguageModel:
    """Fit a model on (language, buckets, counts) rows; without rows it knows no language."""
    languages = sorted({row[0] for row in rows})
    number = {language: i for i, language in enumerate(languages)}
    random = np.random.default_rng(SEED)
    embeddings = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    if not rows:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), bias, 1.0, -np.inf, -np.inf)
    order = random.permutation(len(rows))
    held = int(len(rows) * CALIBRATION_SHARE)
    calibration, training = order[:held], order[held:]
    steps, done = EPOCHS * len(training), 0
    for _ in range(EPOCHS):
        for i in random.permutation(training):
            language, buckets, counts = rows[i]
            rate = LEARNING_RATE * (1 - done / steps)
            done += 1
            share = (counts / counts.sum()).astype(np.float32)
            hidden = share @ embeddings[buckets]
            error = _softmax(hidden @ weights + bias)
            error[number[language]] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            embeddings[buckets] -= rate * len(buckets) ** 0.5 * share[:, None] * back
    seen = np.ones((BUCKETS, len(languages)))
    for i in training:
        language, buckets, counts = rows[i]
        seen[buckets, number[language]] += counts
    table = np.hstack([embeddings @ weights, np.log(seen / seen.sum(axis=0))]).astype(np.float32)
    if not held:
        return LanguageModel(languages, table, bias, 1.0, -np.inf, -np.inf)
    logits = np.array([_mean(table[:, : len(languages)], rows[i]) + bias for i in range(len(rows))])
    labels = np.array([number[row[0]] for row in rows])
    temperature = _temperature(logits[calibration], labels[calibration])
    logits /= temperature
    right = logits.argmax(axis=1) == labels
    odds = [_log_odds(logits[i], labels[i]) for i in calibration if right[i]]
    # A training row is as familiar as it would be had the model not seen it.
    own = np.isin(np.arange(len(rows)), training)
    familiar = [
        _familiarity(seen[:, labels[i]], rows[i], bool(own[i])) for i in np.flatnonzero(right)
    ]
    return LanguageModel(
        languages, table, bias, temperature,
        _low_end(np.array(odds)) if odds and len(languages) > 1 else -np.inf,
        _low_end(np.array(familiar)) if familiar else -np.inf,
    )


def training_sample(labelled: DataFrame, text: str, language: str, key: Column) -> list[tuple]:
    """At most ROWS_PER_LANGUAGE rows of each language as (language, buckets, counts).

    The rows with the smallest hashes of ``key`` and text are drawn, so a rerun draws the
    same ones; repeated rows are drawn once.  A share of the hash range with about
    ``MARGIN`` times the rows wanted is looked through, so no task sees a whole language.
    """
    hashed = labelled.select(
        F.col(language).alias("language"), F.col(text).alias("text"),
        F.xxhash64(key, F.col(text), F.lit(SEED)).alias("draw"),
    )
    # One row per label.  The model, which is broadcast anyway, has 65,536 per label.
    shares = hashed.groupBy("language").agg(
        (MARGIN * ROWS_PER_LANGUAGE / F.approx_count_distinct("draw")).alias("share")
    )
    drawn = (
        hashed.join(F.broadcast(shares), "language")
        .filter(F.pmod("draw", F.lit(1 << 30)) < F.col("share") * (1 << 30))
        .drop("share").dropDuplicates(["language", "draw"])
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_features(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("language"), batch.column("draw"),
                 pa.array([b.tobytes() for b, _ in rows], pa.binary()),
                 pa.array([c.tobytes() for _, c in rows], pa.binary())],
                names=["language", "draw", "buckets", "counts"],
            )

    order = Window.partitionBy("language").orderBy(F.pmod("draw", F.lit(1 << 30)), "draw")
    collected = (
        drawn.mapInArrow(features, "language string, draw bigint, buckets binary, counts binary")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= ROWS_PER_LANGUAGE).collect()
    )
    rows = [
        (r["language"], r["draw"], np.frombuffer(r["buckets"], np.int32),
         np.frombuffer(r["counts"], np.int32))
        for r in collected
    ]
    rows.sort(key=lambda row: (row[1], row[0], row[2].tobytes()))
    return [(language, buckets, counts) for language, _, buckets, counts in rows if len(buckets)]


def train(
    docs: DataFrame, where: Column, text_column: str = "text", language_column: str = "lang",
    id_column: str = "doc_id",
) -> LanguageModel:
    """Train on the rows of ``docs`` that ``where`` picks and that have a text and a label."""
    labelled = docs.filter(
        where & F.col(language_column).isNotNull() & F.col(text_column).isNotNull()
    )
    return fit(training_sample(labelled, text_column, language_column, F.col(id_column)))


def classify(text: str | None, model: LanguageModel) -> tuple[str, float, bool]:
    """(language, calibrated probability, rejected) of a whole text.

    Of languages with equal chances the first by name is predicted.
    """
    if not has_letter(text) or not model.languages:
        return UNKNOWN, 0.0, True
    total, grams = np.zeros(2 * len(model.languages)), 0
    for buckets in gram_buckets(text):
        total += model.table.take(buckets, axis=0).sum(axis=0, dtype=np.float64)
        grams += len(buckets)
    logits, familiar = np.split(total / grams, 2)
    logits = (logits + model.bias) / model.temperature
    best = int(logits.argmax())
    sure = _log_odds(logits, best) >= model.least_odds
    rejected = not (sure and familiar[best] >= model.least_familiarity)
    return model.languages[best], float(_softmax(logits)[best]), rejected


def predict(
    docs: DataFrame, model: LanguageModel, text_column: str = "text", output: str = "language"
) -> DataFrame:
    """The same rows with ``output``, a struct of lang_pred, score, rejected.

    A null text, or one without a letter, is ``und`` with score 0 and rejected; so is
    every text when the model has seen no labelled row.  Only the text is an input.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def classified(texts: pa.Array) -> pa.Array:
        found = [classify(text, shared.value) for text in texts.to_pylist()]
        names = ["lang_pred", "score", "rejected"]
        return pa.array(
            [dict(zip(names, row)) for row in found],
            pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]),
        )

    return docs.withColumn(output, classified(F.col(text_column)))
