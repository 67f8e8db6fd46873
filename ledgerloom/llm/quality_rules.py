"""Quality rules whose thresholds follow the data: quantile sketches per language and source.

A sketch is a count per logarithmic bucket: counts add, so sketches of any parts of the
data merge exactly and in any order, and a quantile is known up to the width of a bucket,
twice ``RELATIVE_ERROR``.  Short texts vary more than long ones, so a sketch covers the texts of
one length class.  Groups too small to judge by themselves borrow the merged sketch of
their language and class, then of their class, then of all rows.

Both fences come from the sketch alone: as far again ``SPREADS`` times beyond an outer
quantile as that quantile lies from the median.  No value is fixed in advance, so a group
in which nearly no text has a symbol rejects texts with symbols, and a group of tables
full of them does not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerloom.llm.packing import compact_checkpoint
from ledgerloom.operators.skew import skew_safe_join
from ledgerloom.session import reliable_checkpoint

SYMBOLS = b"#*$%&|<>"
WINDOW_WORDS = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

RELATIVE_ERROR = 0.01
# Values below this share one bucket.
SMALLEST = 1e-6
# Outer quantiles, and how many times their distance from the median a fence lies beyond.
LOW, MIDDLE, HIGH = 0.1, 0.5, 0.9
SPREADS = 3.0
# A sketch of fewer rows says too little about its outer quantiles.
LEAST_ROWS = 200
# Feature -> (count, whole, least change of the count).  One symbol, one copied line or one
# window found twice is the resolution of a text, and never decides by itself.
FEATURES = {
    "word_length": ("word_chars", "n_words", 0),
    "symbol_share": ("n_symbols", "word_chars", 1),
    "dup_line_share": ("n_dup_lines", "n_lines", 1),
    "repeat_share": ("n_repeat_words", "n_words", 2 * WINDOW_WORDS),
}


class _Numbers(dict):
    """Numbers words in the order they first come up."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _numbered_pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Equal pairs of numbers get equal numbers, others different ones."""
    base = int(second.max(initial=0)) + 1
    return np.unique(first * base + second, return_inverse=True)[1]


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five that occur twice or more.

    Windows are numbered exactly, from words to pairs to fours to fives, in arrays.
    """
    if len(words) < WINDOW_WORDS:
        return 0
    numbers = _Numbers()
    one = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    two = _numbered_pairs(one[:-1], one[1:])
    four = _numbered_pairs(two[:-2], two[2:])
    five = _numbered_pairs(four[:-1], one[4:])
    again = (np.bincount(five) > 1)[five]
    covered = np.zeros(len(words), bool)
    for step in range(WINDOW_WORDS):
        covered[step : step + len(again)] |= again
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in COUNTS, over the whole text; all zero for null."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode()
    words = data.split()  # bytes split at ASCII white space only
    blanks = sum(data.count(space) for space in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = sum(data.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    return (
        len(words), len(text) - blanks, symbols, len(lines), len(lines) - len(set(lines)),
        repeated_words(words),
    )


def with_counts(docs: DataFrame, columns: list[str], text_column: str) -> DataFrame:
    """The given columns and one column per count."""
    kept = docs.select(*columns, F.col(text_column).alias("__text"))
    schema = kept.drop("__text").schema
    for name in COUNTS:
        schema = schema.add(name, LongType())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_counts(text) for text in batch.column("__text").to_pylist()]
            counted = [pa.array(column, pa.int64()) for column in zip(*rows)]
            counted = counted or [pa.array([], pa.int64())] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in columns), *counted], names=[*columns, *COUNTS]
            )

    return kept.mapInArrow(count, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def length_class() -> Column:
    """Half the binary digits of the number of words: a class spans a factor of four."""
    return F.floor((F.length(F.bin("n_words")) + 1) / 2).cast("int")


def feature(name: str, change: int = 0) -> Column:
    """Value of a feature with its count moved by ``change`` units; 0 without words or lines."""
    count, whole, unit = FEATURES[name]
    return F.coalesce(F.try_divide(F.col(count) + change * unit, F.col(whole)), F.lit(0.0))


_GAMMA = (1 + RELATIVE_ERROR) / (1 - RELATIVE_ERROR)


def bucket_of(value: Column) -> Column:
    return F.ceil(F.log(F.greatest(value, F.lit(SMALLEST))) / math.log(_GAMMA)).cast("int")


def bucket_value(bucket: Column, edge: str = "middle") -> Column:
    """The value in the middle or on the lower or upper edge of a bucket; 0 for the lowest."""
    lowest = math.ceil(math.log(SMALLEST) / math.log(_GAMMA))
    inside = {
        "low": F.pow(F.lit(_GAMMA), bucket - 1),
        "middle": F.pow(F.lit(_GAMMA), bucket) * (2 / (1 + _GAMMA)),
        "high": F.pow(F.lit(_GAMMA), bucket),
    }
    return F.when(bucket <= lowest, 0.0).otherwise(inside[edge])


def sketches(counted: DataFrame, groups: list[str]) -> DataFrame:
    """Rows per group, feature and bucket: one mergeable sketch per group and feature."""
    stacked = F.explode(
        F.array(*[
            F.struct(F.lit(name).alias("feature"), bucket_of(feature(name)).alias("bucket"))
            for name in FEATURES
        ])
    )
    return (
        counted.select(*groups, stacked.alias("s"))
        .groupBy(*groups, "s.feature", "s.bucket")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return sketch.groupBy(*groups, "feature", "bucket").agg(F.sum("rows").alias("rows"))


def quantiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Per group and feature: ``rows`` and the quantiles ``low``, ``middle`` and ``high``.

    The outer ones are read at the outer edges of their buckets, so what a sketch cannot
    tell apart widens the fences.  The window runs over the buckets of one sketch, whose
    number the error bounds.
    """
    own = Window.partitionBy(*groups, "feature")
    upto = own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumns({"upto": F.sum("rows").over(upto), "n": F.sum("rows").over(own)})
    at = lambda q, edge: bucket_value(
        F.min(F.when(F.col("upto") >= F.ceil(q * F.col("n")), F.col("bucket"))), edge
    ).alias(edge)
    return ranked.groupBy(*groups, "feature").agg(
        F.max("n").alias("rows"), at(LOW, "low"), at(MIDDLE, "middle"), at(HIGH, "high")
    )


def fences(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Per group a map ``fences``: feature -> (least, most) value kept.

    ``groups`` run from the coarsest column to the finest.  The finest level with at least
    LEAST_ROWS rows decides; the whole table always may.
    """
    wide, decided = sketch.select(*groups, "feature").distinct(), None
    for depth in range(len(groups) + 1):
        own = groups[:depth]
        level = quantiles(merged(sketch, own), own).select(
            F.col("feature").alias("of_feature"), *[F.col(name).alias(f"of_{name}") for name in own],
            F.struct("rows", "low", "middle", "high").alias(f"level{depth}"),
        )
        same = F.col("feature") == F.col("of_feature")
        for name in own:
            same &= F.col(name).eqNullSafe(F.col(f"of_{name}"))
        wide = wide.join(level, same).drop("of_feature", *[f"of_{name}" for name in own])
        found = F.col(f"level{depth}")
        if depth:
            decided = F.when(found["rows"] >= LEAST_ROWS, found).otherwise(decided)
        else:
            decided = found
    wide = wide.select(*groups, "feature", decided.alias("q"))
    limits = F.struct(
        (F.col("q.low") - SPREADS * (F.col("q.middle") - F.col("q.low"))).alias("least"),
        (F.col("q.high") + SPREADS * (F.col("q.high") - F.col("q.middle"))).alias("most"),
    )
    return wide.groupBy(*groups).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", limits))).alias("fences")
    )


def judge(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    language_column: str = "lang", source_column: str = "source",
) -> DataFrame:
    """One row per document row: id, counts, ``base_failed``, ``outliers``, ``kept``.

    ``outliers`` names the features beyond the fences of the document's language, source
    and length class, after its count is moved one unit towards them.  A null language or
    source is a group like any other.  Null and empty texts have no words, so they fail the
    base rule.  Thresholds are learned from all rows that pass the base rule; a group in
    which no row passes has none, and no outliers.  Repeated rows count as often as they
    occur.  A value on a fence stays.
    """
    source = docs.select(
        F.col(id_column).alias("id"), F.col(language_column).alias("language"),
        F.col(source_column).alias("origin"), F.col(text_column).alias("text"),
    )
    groups = ["length", "language", "origin"]
    counted = with_counts(source, ["id", "language", "origin"], "text")
    counted = reliable_checkpoint(
        counted.withColumns({"base_failed": base_failed(), "length": length_class()})
    )
    sketch = sketches(counted.filter(~F.col("base_failed")), groups)
    limits = fences(compact_checkpoint(sketch), groups)
    limits = limits.select(F.struct(*groups).alias("of"), "fences")
    # A struct is compared field by field, null equal to null.
    judged = skew_safe_join(counted.withColumn("of", F.struct(*groups)), limits, ["of"], "left")
    beyond = [
        F.when(
            (feature(name, -1) > F.col("fences")[name]["most"])
            | (feature(name, +1) < F.col("fences")[name]["least"]),
            F.lit(name),
        )
        for name in FEATURES
    ]
    outliers = F.array_compact(F.array(*beyond))
    return judged.select(
        F.col("id").alias(id_column), *COUNTS, "base_failed", outliers.alias("outliers"),
        (~F.col("base_failed") & (F.size(outliers) == 0)).alias("kept"),
    )
