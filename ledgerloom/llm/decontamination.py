"""Benchmark decontamination by winnowing, in DataFrame expressions only.

Words are hashed in overlapping grams of ``gram`` words, and in every stretch of
``window - gram + 1`` grams the smallest hash is kept.  Two texts that share ``window``
words keep the same gram of it, so an equality join of the kept hashes misses no shared
window.  A join hit fixes how the two texts would lie on each other; the words are then
compared over the whole benchmark item, so chance hits count for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import let
from ledgerloom.llm.packing import compact_checkpoint, row_key

WINDOW_WORDS = 10
GRAM_WORDS = 5
# The benchmark's kept hashes are broadcast up to this many rows (about 100 bytes each).
BROADCAST_ROWS = 500_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A kept gram is one BIGINT: hash above, position in the text modulo 2**24 below.  Ties go
# to the smaller position, so both texts keep the same one.
_PLACE_BITS = 24
_PLACES = (1 << _PLACE_BITS) - 1


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _BETWEEN_WORDS), "")


def _range(last: Column) -> Column:
    """0 to ``last``; empty if that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(hashes: Column, gram: int) -> Column:
    return F.transform(
        _range(F.size(hashes) - gram), lambda i: F.xxhash64(F.slice(hashes, i + 1, F.lit(gram)))
    )


def kept_grams(words: Column, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> Column:
    """Array of (hash, place) of the grams that winnowing keeps."""
    stretch = window - gram + 1

    def placed(grams: Column) -> Column:
        return F.transform(
            grams,
            lambda g, i: g.bitwiseAND(F.lit(~_PLACES)).bitwiseOR(
                i.cast("bigint").bitwiseAND(F.lit(_PLACES))
            ),
        )

    def smallest(values: Column) -> Column:
        return F.transform(
            _range(F.size(values) - stretch),
            lambda i: F.array_min(F.slice(values, i + 1, F.lit(stretch))),
        )

    def changes(values: Column) -> Column:
        """One entry per run of one kept gram, with its true place."""
        runs = F.transform(
            values,
            lambda v, i: F.when(
                (i == 0) | (v != F.element_at(values, F.greatest(i, F.lit(1)))),
                F.struct(
                    F.shiftright(v, _PLACE_BITS).alias("hash"),
                    (i + F.pmod(v - i, F.lit(_PLACES + 1))).cast("int").alias("place"),
                ),
            ),
        )
        return F.array_compact(runs)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    grams = let(hashes, lambda h: _gram_hashes(h, gram))
    return let(let(let(grams, placed), smallest), changes)


def short_grams(words: Column, length: int) -> Column:
    """Array of (hash, place) of every run of ``length`` words."""
    grams = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _gram_hashes(h, length))
    return F.transform(
        grams, lambda g, i: F.struct(F.shiftright(g, _PLACE_BITS).alias("hash"), i.alias("place"))
    )


def _benchmark_grams(items: DataFrame, window: int, gram: int) -> DataFrame:
    """(length, hash, item_place, item): ``length`` is 0 for winnowed grams."""
    long = items.filter(F.size("item_words") >= window).select(
        F.lit(0).alias("length"), "item", F.explode(kept_grams(F.col("item_words"), window, gram)).alias("g")
    )
    short = items.filter(F.size("item_words") < window).select(
        F.size("item_words").alias("length"), "item",
        F.explode(short_whole(F.col("item_words"))).alias("g"),
    )
    return long.unionByName(short).select(
        "length", "item", F.col("g.hash").alias("hash"), F.col("g.place").alias("item_place")
    )


def short_whole(words: Column) -> Column:
    """The one gram of an item shorter than a window: all its words."""
    return F.array(
        F.struct(
            F.shiftright(F.xxhash64(F.transform(words, lambda w: F.xxhash64(w))), _PLACE_BITS)
            .alias("hash"),
            F.lit(0).alias("place"),
        )
    )


def _hits(words: Column, candidates: Column, window: int) -> Column:
    """(item_id, start, length) of every item window that lies in the words."""

    def of_item(c: Column) -> Column:
        length = F.least(F.lit(window), F.size(c["item_words"]))
        same = lambda i: (
            (c["shift"] + i >= 0)
            & (c["shift"] + i + length <= F.size(words))
            & (F.slice(words, F.greatest(c["shift"] + i + 1, F.lit(1)), length)
               == F.slice(c["item_words"], i + 1, length))
        )
        starts = F.filter(F.sequence(F.lit(0), F.size(c["item_words"]) - length), same)
        return F.transform(
            starts,
            lambda i: F.struct(
                c["item_id"].alias("item_id"), (c["shift"] + i).alias("start"), length.alias("length")
            ),
        )

    return F.flatten(F.transform(candidates, of_item))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, each judged by its own text."""
    key = row_key(names.get("id_column", "doc_id"), names.get("text_column", "text"))
    leaks = _judged(docs, benchmark, **names).filter("contaminated")
    leaks = leaks.select(F.col("key").alias("__leak")).distinct()
    keyed = docs.withColumn("__row", key)
    return keyed.join(leaks, F.col("__row") == F.col("__leak"), "left_anti").drop("__row")


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", window: int = WINDOW_WORDS,
    gram: int = GRAM_WORDS, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document row: id, ``n_words``, ``n_hit``, ``items``, ``contaminated``.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item,
    or of a whole item with fewer words; ``items`` is the sorted array of those items' ids
    as strings.  Null texts have no words, items without words have no window, null item
    ids are counted as hits but not listed, and repeated rows are judged one by one.
    """
    judged = _judged(
        docs, benchmark, id_column, text_column, item_column, item_text_column, window, gram,
        broadcast_rows,
    )
    return judged.drop("key")


def _judged(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", window: int = WINDOW_WORDS,
    gram: int = GRAM_WORDS, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """What ``find_leaks`` gives, and the ``key`` of each row."""
    items = compact_checkpoint(
        benchmark.select(
            F.col(item_column).cast("string").alias("item_id"),
            words_of(F.col(item_text_column)).alias("item_words"),
        )
        .filter(F.size("item_words") > 0)
        .groupBy("item_id", "item_words").agg(F.lit(1).alias("one")).drop("one")
        .withColumn("item", F.xxhash64("item_id", "item_words"))
    )
    grams = compact_checkpoint(_benchmark_grams(items, window, gram))
    lengths = {row["length"]: row["n"] for row in
               grams.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    fits = sum(lengths.values()) <= broadcast_rows
    small = (lambda df: F.broadcast(df)) if fits else (lambda df: df)

    source = docs.select(
        row_key(id_column, text_column).alias("key"), F.col(text_column).alias("text")
    )
    worded = source.select("key", words_of(F.col("text")).alias("words"))
    found = None
    for length in sorted(lengths):
        taken = kept_grams(F.col("words"), window, gram) if length == 0 else short_grams(
            F.col("words"), length
        )
        placed = worded.select("key", F.explode(taken).alias("g")).select(
            "key", F.col("g.hash").alias("hash"), F.col("g.place").alias("place")
        )
        own = grams.filter(F.col("length") == length).drop("length")
        hits = placed.join(small(own), "hash").select(
            "key", "item", (F.col("place") - F.col("item_place")).alias("shift")
        )
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = source.select(
            "key", F.lit(0).cast("bigint").alias("item"), F.lit(0).alias("shift")
        ).limit(0)
    aligned = found.distinct().join(small(items), "item")
    per_document = aligned.groupBy(F.col("key").alias("found_key")).agg(
        F.collect_list(F.struct("item_id", "item_words", "shift")).alias("candidates")
    )
    joined = source.join(per_document, F.col("key") == F.col("found_key"), "left")
    judged = joined.select(
        "key",
        let(
            words_of(F.col("text")),
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.when(F.col("candidates").isNotNull(), _hits(w, F.col("candidates"), window))
                .alias("hits"),
            ),
        ).alias("r"),
    ).select("key", "r.n_words", "r.hits")
    covered = F.array_distinct(
        F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1)))
    )
    listed = F.array_sort(F.array_distinct(F.array_compact(F.transform("hits", lambda h: h["item_id"]))))
    n_hit = F.coalesce(F.size(covered), F.lit(0)).cast("bigint")
    return judged.select(
        "key", F.col("key.id").alias(id_column), "n_words",
        F.when(F.col("hits").isNull(), F.lit(0)).otherwise(n_hit).cast("bigint").alias("n_hit"),
        F.coalesce(listed, F.array().cast("array<string>")).alias("items"),
    ).withColumn("contaminated", F.col("n_hit") > 0)
