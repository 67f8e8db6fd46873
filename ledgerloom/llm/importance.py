"""Importance resampling towards a target: draw the documents most like a target text set.

Features are runs of one to three words.  Texts and target are reduced to feature counts
per hash bucket; the log ratio of both is a bucket's gain, a document's weight is the sum
of its features' gains, and the highest weights plus Gumbel noise are a draw without
replacement.

The occurrences of a batch of texts are interned in an open-addressed NumPy table: the key
is the XXH64 of the feature's bytes, equal keys are verified byte by byte, and a slot holds
the feature's bucket and count.  Each different feature is so hashed into its bucket once a
batch, and the slot numbers of the occurrences gather the gains.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerloom.llm.packing import lean_memory
from ledgerloom.operators.ordering import running_counts
from ledgerloom.session import reliable_checkpoint

BUCKETS = 10_000
RUN_WORDS = 3
SMOOTHING = 1
# Gains and noise are whole thousandths, rounded down.
UNITS = 1000
SEED = 42
DRAWN_PERCENT, LEAST_WORDS = 5, 20
# Bytes of text interned together; longer texts are cut between words.
CHUNK_BYTES = 1 << 20

_SPACE = 0x20
# Byte -> its lower-case form inside a word (digits, letters, bytes above ASCII), else space.
_FOLDED = np.full(256, _SPACE, np.uint8)
for _low, _high, _shift in ((0x30, 0x3A, 0), (0x41, 0x5B, 0x20), (0x61, 0x7B, 0), (0x80, 0x100, 0)):
    _FOLDED[_low:_high] = np.arange(_low, _high) + _shift

# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
))
# Features of this many bytes or more are hashed and compared one by one.
_LONG = 32


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Words:
    """Words of a chunk, folded, in one buffer with a space before each word.

    ``start`` and ``end`` are their places in the buffer, so a run of words of one text is
    one slice of it; ``text`` is the number of the text of each word.
    """

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        folded = _FOLDED[raw]
        inside = folded != _SPACE
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        places = np.flatnonzero(inside)
        opens = first[places]
        at = np.arange(len(places)) + np.cumsum(opens)
        # Eight spare bytes: the last eight-byte read starts inside the last word.
        self.buffer = np.full(len(places) + int(opens.sum()) + 8, _SPACE, np.uint8)
        self.buffer[at] = folded[places]
        begins = np.flatnonzero(opens)
        self.start = at[begins]
        self.end = np.append(self.start[1:] - 1, len(self.buffer) - 8)[: len(begins)]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        text_starts = np.cumsum(lengths + 1) - lengths - 1
        self.text = np.searchsorted(text_starts, places[begins], "right") - 1

    def runs(self, new_from: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and text of all runs that end with a word from ``new_from`` on."""
        parts = []
        for words in range(1, RUN_WORDS + 1):
            last = np.arange(max(new_from, words - 1), len(self.start))
            head = last - (words - 1)
            same = self.text[head] == self.text[last]
            last, head = last[same], head[same]
            parts.append((self.start[head], self.end[last] - self.start[head], self.text[last]))
        return tuple(np.concatenate(column) for column in zip(*parts))

    def tail(self, words: int) -> bytes:
        """The last words, or as many as there are."""
        kept = self.start[-words:]
        return self.buffer[kept[0] : len(self.buffer) - 8].tobytes() if len(kept) else b""


def short_hashes(views: "Views", start: np.ndarray, length: int) -> np.ndarray:
    """XXH64 (seed 0) of slices of one length below 32 bytes."""
    h = np.full(len(start), _P5 + np.uint64(length))
    at = 0
    while at + 8 <= length:
        h ^= _turned(views.eights.take(start + at) * _P2, 31) * _P1
        h = _turned(h, 27) * _P1 + _P4
        at += 8
    if at + 4 <= length:
        h ^= views.fours.take(start + at).astype(np.uint64) * _P1
        h = _turned(h, 23) * _P2 + _P3
        at += 4
    for byte in range(at, length):
        h ^= views.bytes.take(start + byte).astype(np.uint64) * _P5
        h = _turned(h, 11) * _P1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    return h ^ (h >> np.uint64(32))


def _byte_steps(states: np.ndarray, steps: int) -> np.ndarray:
    """CRC-32 states after so many zero bytes."""
    for _ in range(8 * steps):
        states = (states >> np.uint32(1)) ^ np.where(states & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return states


# A CRC is linear, so four bytes are two steps by half of the state each.
_STATES = np.arange(1 << 16, dtype=np.uint32)
_CRC_BYTE = _byte_steps(_STATES[:256], 1)
_CRC_LOW, _CRC_HIGH = _byte_steps(_STATES, 4), _byte_steps(_STATES << np.uint32(16), 4)


def short_crcs(views: "Views", start: np.ndarray, length: int) -> np.ndarray:
    """CRC-32 of slices of one length."""
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    at = 0
    while at + 4 <= length:
        crc ^= views.fours.take(start + at)
        low, high = crc & np.uint32(0xFFFF), crc >> np.uint32(16)
        crc = _CRC_LOW.take(low.astype(np.int64)) ^ _CRC_HIGH.take(high.astype(np.int64))
        at += 4
    for byte in range(at, length):
        low = (crc ^ views.bytes.take(start + byte)) & np.uint32(0xFF)
        crc = _CRC_BYTE.take(low.astype(np.int64)) ^ (crc >> np.uint32(8))
    return ~crc


class Views:
    """A buffer's bytes, and the four and eight bytes that start at each of its places."""

    def __init__(self, buffer: np.ndarray):
        self.bytes, self.raw = buffer, memoryview(buffer)
        wide = lambda kind, width: np.ascontiguousarray(
            np.ndarray((len(buffer) - width + 1,), kind, buffer, strides=(1,))
        )
        self.fours, self.eights = wide("<u4", 4), wide("<u8", 8)

    def slices(self, start: np.ndarray, length: np.ndarray) -> Iterator[memoryview]:
        return (self.raw[s : s + n] for s, n in zip(start.tolist(), length.tolist()))


class FeatureTable:
    """Different features of a chunk in an open-addressed table with linear probing.

    Occurrences are taken length by length; ``order`` is the order they are taken in.  A
    slot holds the key of its feature, the occurrence that took it, the bucket, the count.
    """

    def __init__(self, words: Words, start: np.ndarray, length: np.ndarray):
        self.views = Views(words.buffer)
        size = 1 << max(4, (2 * len(start) - 1).bit_length())  # at most half full
        self.mask = np.uint64(size - 1)
        self.key = np.zeros(size, np.uint64)  # 0: a free slot
        self.owner = np.empty(size, np.int64)
        self.bucket = np.zeros(size, np.int64)
        sizes = np.minimum(length, _LONG).astype(np.uint8)
        self.order = np.argsort(sizes, kind="stable")
        self.start, self.length = start[self.order], length[self.order]
        self.slots = np.empty(len(start), np.int64)
        cuts = np.cumsum(np.bincount(sizes, minlength=_LONG + 1)).tolist()
        for width in range(1, _LONG + 1):
            if cuts[width - 1] < cuts[width]:
                self._intern(cuts[width - 1], cuts[width], width)
        self.count = np.bincount(self.slots, minlength=size)

    def _keys(self, low: int, high: int, width: int) -> np.ndarray:
        start = self.start[low:high]
        if width < _LONG:
            keys = short_hashes(self.views, start, width)
        else:
            slices = self.views.slices(start, self.length[low:high])
            keys = np.fromiter(map(xxhash.xxh64_intdigest, slices), np.uint64, high - low)
        keys[keys == 0] = 1  # a key like any other: the bytes decide
        return keys

    def _equal(self, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
        """Whether the occurrences ``a`` and ``b`` have the same bytes."""
        x, y = self.start.take(a), self.start.take(b)
        if width >= _LONG:
            pairs = zip(self.views.slices(x, self.length[a]), self.views.slices(y, self.length[b]))
            return np.fromiter((one == other for one, other in pairs), bool, len(a))
        eights = self.views.eights
        if width < 8:  # the bytes behind the slices are shifted out
            return (eights.take(x) ^ eights.take(y)) << np.uint64(64 - 8 * width) == 0
        same = eights.take(x + (width - 8)) == eights.take(y + (width - 8))
        for at in range(0, width - 8, 8):
            same &= eights.take(x + at) == eights.take(y + at)
        return same

    def _intern(self, low: int, high: int, width: int) -> None:
        """Find or take a slot for the occurrences ``low`` to ``high``: of one length, or all long."""
        key = self._keys(low, high, width)
        slot = (key & self.mask).astype(np.int64)
        rows = np.arange(low, high)
        taken = []
        while len(rows):
            there = self.key.take(slot)
            free = np.flatnonzero(there == 0)
            wanted, wish = slot.take(free), key.take(free)
            self.key[wanted] = wish  # of several claims on a slot the last one stands
            there[free] = now = self.key.take(wanted)
            won = np.flatnonzero(now == wish)
            wanted, claims = wanted.take(won), rows.take(free.take(won))
            self.owner[wanted] = claims
            own = self.owner.take(wanted) == claims
            taken.append(wanted[own])
            done = there == key
            done[free.take(won[own])] = False  # owners need no comparison
            like = np.flatnonzero(done)
            owner = self.owner.take(slot.take(like))
            # Occurrences before ``low`` have another length, and so other bytes.
            equal = owner >= low
            equal[equal] = self._equal(rows.take(like[equal]), owner[equal], width)
            done[like] = equal
            done[free.take(won[own])] = True
            self.slots[rows[done]] = slot[done]
            rest = np.flatnonzero(~done)
            rows, key = rows.take(rest), key.take(rest)
            slot = (slot.take(rest) + 1) & np.int64(self.mask)
        used = np.concatenate(taken)
        first = self.owner.take(used)
        start = self.start.take(first)
        if width < _LONG:
            crcs = short_crcs(self.views, start, width)
        else:
            crcs = np.fromiter(map(zlib.crc32, self.views.slices(start, self.length[first])), np.uint32, len(used))
        self.bucket[used] = crcs % np.uint32(BUCKETS)


def chunks(texts: list[bytes | None], chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes], bool]]:
    """(number of the first text, texts, whether this goes on inside that text).

    Texts come together up to ``chunk_bytes``; a longer one comes alone in pieces of about
    so many bytes, cut between words.
    """
    held, first, size = [], 0, 0
    for number, text in enumerate(texts):
        text = text or b""
        if size and size + len(text) > chunk_bytes:
            yield first, held, False
            held, size = [], 0
        if not held:
            first = number
        if len(text) <= chunk_bytes:
            held.append(text)
            size += len(text) + 1
            continue
        if held:
            yield first, held, False
        held, size, at = [], 0, 0
        while at < len(text):
            end = min(len(text), at + chunk_bytes)
            while end < len(text):  # to the end of the word
                ahead = _FOLDED[np.frombuffer(text, np.uint8, min(4096, len(text) - end), end)] == _SPACE
                step = int(ahead.argmax()) if ahead.any() else len(ahead)
                end += step
                if step < len(ahead):
                    break
            yield number, [text[at:end]], at > 0
            at = end
    if held:
        yield first, held, False


def interned(
    texts: list[bytes | None], chunk_bytes: int = CHUNK_BYTES
) -> Iterator[tuple[FeatureTable, np.ndarray, np.ndarray]]:
    """Per chunk: the table, the texts of its occurrences, and the texts of all words."""
    carried = b""
    for first, held, goes_on in chunks(texts, chunk_bytes):
        skipped = 0
        if goes_on and carried:  # the words that runs of this piece may start with
            skipped = carried.count(b" ") + 1
            held = [carried + b" " + held[0]]
        words = Words(held)
        start, length, text = words.runs(skipped)
        table = FeatureTable(words, start, length)
        yield table, text[table.order] + first, words.text[skipped:] + first
        carried = words.tail(RUN_WORDS - 1)


def bucket_totals(texts: list[bytes | None], chunk_bytes: int = CHUNK_BYTES) -> np.ndarray:
    """Occurrences per bucket."""
    totals = np.zeros(BUCKETS, np.int64)
    for table, *_ in interned(texts, chunk_bytes):
        # Sums of whole numbers far below 2**53: exact in doubles, here and below.
        totals += np.bincount(table.bucket, table.count, BUCKETS).astype(np.int64)
    return totals


def text_weights(
    texts: list[bytes | None], gains: np.ndarray, chunk_bytes: int = CHUNK_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, features and summed gains of every text."""
    words, features, weights = (np.zeros(len(texts), np.int64) for _ in range(3))
    for table, owner, word_owner in interned(texts, chunk_bytes):
        words += np.bincount(word_owner, minlength=len(texts))
        features += np.bincount(owner, minlength=len(texts))
        found = gains.take(table.bucket).take(table.slots)
        weights += np.bincount(owner, found, minlength=len(texts)).astype(np.int64)
    return words, features, weights


def _as_bytes(texts: pa.Array) -> list[bytes | None]:
    return texts.cast(pa.binary()).to_pylist()


def bucket_counts(docs: DataFrame, text_column: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``bucket`` and ``n``, the occurrences of its features in all texts; no row where none.

    A task adds up its own counts first, so it sends at most one row per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        totals = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            totals += bucket_totals(_as_bytes(batch.column(0)), chunk_bytes)
        found = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(found, pa.int32()), "n": pa.array(totals[found])})

    texts = docs.select(F.col(text_column).alias("text"))
    return texts.mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame) -> np.ndarray:
    """At most BUCKETS rows, whatever the texts."""
    dense = np.zeros(BUCKETS, np.int64)
    for bucket, n in counts.collect():
        dense[bucket] = n
    return dense


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of target and source, in thousandths, rounded down."""
    all_source, all_target = (float(n.sum() + SMOOTHING * BUCKETS) for n in (source, target))
    return np.array(
        [
            math.floor(UNITS * math.log((t + SMOOTHING) * all_source / ((s + SMOOTHING) * all_target)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def train(docs: DataFrame, target: DataFrame, text_column: str = "text", target_column: str = "text") -> np.ndarray:
    """Gain of every bucket, from all texts of both tables; null texts hold no feature."""
    return bucket_gains(
        _dense(bucket_counts(docs, text_column)), _dense(bucket_counts(target, target_column))
    )


def weighed(
    docs: DataFrame, gains: np.ndarray, id_column: str = "doc_id", text_column: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = source.select("id").schema
    for name in ("n_words", "n_features", "weight"):
        schema = schema.add(name, LongType())

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for batch in batches:
            columns = text_weights(_as_bytes(batch.column("text")), gains, chunk_bytes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *map(pa.array, columns)], names=["id", "n_words", "n_features", "weight"]
            )

    return source.mapInArrow(weigh, schema)


def noise(id_column: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a digest of ``seed:id``.

    A null id is written as nothing.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-UNITS * F.log(-F.log((h + 0.5) / float(1 << 32))))


def resample(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    target_column: str = "text", seed: int = SEED, percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per document row: id, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``.

    ``rank`` numbers the drawn rows by falling score from 1 and is null for all others: of
    the rows with at least ``least_words`` words, ``percent`` percent (rounded down) are
    drawn.  Ties go to the smaller id, a null id last; rows with one id and one score stand
    in any order.  Texts without words, null ones too, weigh nothing and have no feature.
    Repeated rows give repeated rows, each counted and drawn for itself; an empty target
    counts as none of all features.  No other column is read.
    """
    gains = train(docs, target, text_column, target_column)
    rows = weighed(docs, gains, id_column, text_column)
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = reliable_checkpoint(rows.withColumn("row", F.monotonically_increasing_id()))
    able = F.col("n_words") >= least_words
    n_drawn = scored.agg(F.count_if(able)).first()[0] * percent // 100
    # Every row has its own place in this order, so no slice of it can hold one value only.
    place = F.struct(
        (~able).alias("out"), (-F.col("score")).alias("by"), F.col("id").isNull().alias("none"),
        "id", "row", "n_words", "n_features", "weight", "score",
    )
    ordered = running_counts(scored.select(place.alias("place")), "place", {"n": F.lit(1)})
    rank = F.col("n_before") + 1
    fields = [F.col(f"place.{name}").alias(name) for name in ("n_words", "n_features", "weight", "score")]
    return ordered.select(
        F.col("place.id").alias(id_column), *fields, F.when(rank <= n_drawn, rank).alias("rank")
    )
