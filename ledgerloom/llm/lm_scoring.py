"""Language-model scores of texts from a log-frequency Bloom filter.

Training counts are gathered over all training texts: words exactly, pairs of neighbouring
words by hash.  A pair seen c times is put into a Bloom filter once for each level from 1
to 1 + floor(log2 c); asking for level after level until one is missing gives its count
back, quantised.  The filter has a slice per bucket of pairs, sized by the entries found, so
it grows with the data and holds every pair.  A slice is read where it is built, for all
pairs that the groups of texts ask for, and their levels go back to the groups.  Texts are
scored with a Dirichlet-smoothed pair model over the exact word counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.packing import (
    PACKED, compact_checkpoint, group_count, lean_memory, mixed, pack, packed_documents,
    packed_table, split_by, unpack,
)
from ledgerloom.session import shuffle_width

# Words hold no white space, so this is none of them.
END = b"\n"
UNIT_WEIGHT = 0.1
# Weight of the word model, in occurrences, when a pair is smoothed.
PAIR_PRIOR = 50.0
BITS_PER_ENTRY = 8
PROBES = 5
MAX_LEVEL = 40
# Bits of a pair hash that are kept within a bucket.
PAIR_BITS = 40
_STATS = -1
# What a group of texts sends to a bucket, as one row: words with their training counts,
# and gaps between sorted pair hashes with theirs; 0 for what only other texts hold.
_ASKED = {"word": pa.binary(), "n": pa.int64(), "gap": pa.uint64(), "times": pa.int64()}
# What it gets back, in the same order.
_ANSWER = {"n": pa.int64(), "level": pa.uint8()}


class _Numbers(dict):
    """Numbers words in the order they first come up."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words with A-Z lower-cased (bytes lower and split in ASCII only), then one end."""
    return [*(text or b"").lower().split(), END]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(word) for word in words), np.uint64, len(words))


def pair_hashes(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + after)


def level_of(count: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count), 0 for 0."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], MAX_LEVEL)


def count_of(level: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; 0 for level 0."""
    return np.where(level > 0, (1.5 * 2.0 ** level - 1) / 2 * (level > 0), 0.0)


def _entry_places(keys: np.ndarray, level: np.ndarray | int, size: np.ndarray | int) -> list[np.ndarray]:
    """Bit numbers of an entry (key and level) in a slice of ``size`` bits."""
    entry = mixed(keys + np.asarray(level, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    step = entry >> np.uint64(32) | np.uint64(1)
    return [(entry + np.uint64(i) * step) % np.uint64(size) if np.isscalar(size)
            else (entry + np.uint64(i) * step) % size for i in range(PROBES)]


def filter_slice(
    keys: np.ndarray, counts: np.ndarray, most_bytes: int | None = None
) -> np.ndarray:
    """Packed bits of the slice of one bucket; it holds every pair, whatever their number.

    Only a caller that gives ``most_bytes``, as scoring does not, has levels dropped from
    below until the entries fit.
    """
    levels = level_of(counts)
    if most_bytes is not None:
        room = most_bytes * 8 // BITS_PER_ENTRY
        entries = np.bincount(levels, minlength=MAX_LEVEL + 2) * np.arange(MAX_LEVEL + 2)
        held = np.cumsum(entries[::-1])[::-1]  # entries of pairs of this level or above
        keep = levels >= max(int(np.argmax(held <= room)), 1)
        keys, levels = keys[keep], levels[keep]
    size = max(int(levels.sum()) * BITS_PER_ENTRY, 8)
    size = -(-size // 8) * 8
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for place in _entry_places(keys[levels >= level], level, size):
            bits[place] = True
    return np.packbits(bits)


@dataclass
class PairFilter:
    """Slices of the filter, one per bucket of pairs."""

    bits: np.ndarray
    begin: np.ndarray  # first byte of each slice
    size: np.ndarray  # bits of each slice

    def levels(self, bucket: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Highest level up to which all entries of a pair are present."""
        found = np.zeros(len(keys), np.int64)
        open_ = np.flatnonzero(self.size[bucket] > 0)
        for level in range(1, MAX_LEVEL + 1):
            if not len(open_):
                break
            sizes, begin = self.size[bucket[open_]], self.begin[bucket[open_]]
            present = np.ones(len(open_), bool)
            for place in _entry_places(keys[open_], level, sizes):
                place = place.astype(np.int64)
                byte = self.bits[begin + (place >> 3)]
                present &= byte >> (7 - (place & 7)).astype(np.uint8) & 1 != 0
            open_ = open_[present]
            found[open_] = level
        return found


def pair_levels(keys: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Level of every asked key, read from the slice that holds all keys with a count."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
    first = np.flatnonzero(new)
    distinct, counts = keys[first], np.add.reduceat(times, first) if len(first) else times
    bits = filter_slice(distinct[counts > 0], counts[counts > 0])
    one = PairFilter(bits, np.zeros(1, np.int64), np.array([len(bits) * 8], np.uint64))
    levels = one.levels(np.zeros(len(distinct), np.int64), distinct)
    found = np.empty(len(keys), np.uint8)
    found[order] = levels[np.cumsum(new) - 1]
    return found


def _bucket_and_key(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    keys = hashes // np.uint64(buckets) & np.uint64((1 << PAIR_BITS) - 1)
    return (hashes % np.uint64(buckets)).astype(np.int32), keys


def _numbered(table: pa.Table) -> Iterator[tuple]:
    """(ids, flags, first token of each text, token numbers, words) per packed batch."""
    numbers = _Numbers()
    for blob in table["blob"].to_pylist():
        batch = unpack(blob)
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found = []
        for text in texts:
            tokens = tokens_of(text)
            found.append(np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens)))
        flags = batch.column("flag").to_numpy(zero_copy_only=False).astype(bool)
        cuts = np.cumsum([0, *(len(f) for f in found)])
        flat = np.concatenate([np.empty(0, np.int64), *found])
        yield batch.column("id"), flags, cuts, flat, numbers


def _pairs(cuts: np.ndarray, flat: np.ndarray, end: int) -> np.ndarray:
    """Number of the token before each token; the end stands before the first."""
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[cuts[:-1]] = end
    return before


@dataclass
class LanguageModel:
    """Counts behind the scores: totals, and answers by group of texts."""

    train_tokens: int
    distinct_tokens: int
    answers: DataFrame
    buckets: int


def _ask(buckets: int):
    def ask(key: tuple, table: pa.Table) -> pa.Table:
        lean_memory()
        tokens, pairs = [np.empty(0, np.int64)], [np.empty((0, 3), np.int64)]
        words: list[bytes] = []
        for _, flags, cuts, flat, numbers in _numbered(table):
            learned = np.repeat(flags, np.diff(cuts))
            before = _pairs(cuts, flat, numbers[END])
            tokens.append(flat[learned])
            pairs.append(np.stack([before, flat, learned], axis=1))
            words = list(numbers)
        counts = np.bincount(np.concatenate(tokens), minlength=len(words))
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        hashes = word_hashes(words)
        asked: dict[int, dict] = {}
        for bucket, own in split_by((hashes[order] % np.uint64(buckets)).astype(np.int32)):
            picked = order[own]
            asked[bucket] = {"word": [words[i] for i in picked], "n": counts[picked]}
        both = np.concatenate(pairs)
        # Pairs that no training text of the group holds are asked for as well, with 0 times.
        joined = np.sort((both[:, 0] * max(len(words), 1) + both[:, 1]) * 2 + both[:, 2])
        first = np.flatnonzero(np.diff(joined >> 1, prepend=-1))
        times = np.add.reduceat(joined & 1, first) if len(first) else joined
        before, after = np.divmod(joined[first] >> 1, max(len(words), 1))
        places, keys = _bucket_and_key(pair_hashes(hashes[before], hashes[after]), buckets)
        for bucket, own in split_by(places):
            own = own[np.argsort(keys[own], kind="stable")]
            asked.setdefault(bucket, {})
            asked[bucket] |= {"gap": np.diff(keys[own], prepend=np.uint64(0)), "times": times[own]}
        return packed_table(
            (bucket, key[0].as_py(), pack({
                name: pa.array([columns.get(name, [])], pa.list_(kind)) for name, kind in _ASKED.items()
            }))
            for bucket, columns in asked.items()
        )

    return ask


def _count(key: tuple, table: pa.Table) -> pa.Table:
    """Totals of a bucket, and for every group the counts and levels of what it asked for."""
    lean_memory()
    bucket, origins = key[0].as_py(), table["origin"].to_pylist()
    asked = [unpack(blob) for blob in table["blob"].to_pylist()]
    totals: dict[bytes, int] = {}
    for batch in asked:
        for word, n in zip(batch.column("word")[0].as_py(), batch.column("n")[0].as_py()):
            totals[word] = totals.get(word, 0) + n
    known = [n for n in totals.values() if n]
    gaps = [np.asarray(batch.column("gap").values) for batch in asked]
    levels = pair_levels(
        np.concatenate([np.cumsum(gap, dtype=np.uint64) for gap in gaps]),
        np.concatenate([np.asarray(batch.column("times").values) for batch in asked]),
    )
    rows = [(_STATS, bucket, pack({"n": [sum(known)], "v": [len(known)]}))]
    cuts = np.cumsum([len(gap) for gap in gaps])[:-1]
    for origin, batch, level in zip(origins, asked, np.split(levels, cuts)):
        own = {"n": [totals[word] for word in batch.column("word")[0].as_py()], "level": level}
        rows.append((origin, bucket, pack({
            name: pa.array([own[name]], pa.list_(kind)) for name, kind in _ANSWER.items()
        })))
    return packed_table(rows)


def train(
    docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text",
) -> tuple[LanguageModel, DataFrame]:
    """The model of the texts that ``learn`` picks, and all texts packed for scoring.

    The counts of words and the levels of pairs go back to the groups of texts that hold
    them; what reaches the driver is two totals per bucket.
    """
    buckets = shuffle_width(docs.sparkSession)
    packed = packed_documents(
        docs, id_column, text_column, group_count(docs), flag=F.coalesce(learn, F.lit(False))
    )
    asked = packed.groupBy("part").applyInArrow(_ask(buckets), PACKED)
    counted = compact_checkpoint(asked.groupBy("part").applyInArrow(_count, PACKED))
    totals = [unpack(row["blob"]) for row in counted.filter(F.col("part") == _STATS).collect()]
    model = LanguageModel(
        sum(t.column("n")[0].as_py() for t in totals), sum(t.column("v")[0].as_py() for t in totals),
        counted.filter(F.col("part") >= 0), buckets,
    )
    return model, packed


def score(
    docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document row: id, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (log10, words alone) and ``score`` (log10, the pair model).

    A null or empty text is one end token.  Rows for which ``learn`` is null are scored
    but not learned from.  With nothing to learn from every token has one chance.
    """
    model, packed = train(docs, learn, id_column, text_column)
    buckets, total = model.buckets, model.train_tokens
    whole = total + UNIT_WEIGHT * (model.distinct_tokens + 1)

    def scored(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        lean_memory()
        batches = list(_numbered(table))
        words = list(batches[-1][4])
        hashes = word_hashes(words)
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        replies = {
            origin: unpack(blob)
            for origin, blob in zip(answers["origin"].to_pylist(), answers["blob"].to_pylist())
        }
        counts = np.zeros(len(words), np.int64)
        for bucket, own in split_by((hashes[order] % np.uint64(buckets)).astype(np.int32)):
            counts[order[own]] = np.asarray(replies[bucket].column("n").values)
        chance = (counts + UNIT_WEIGHT) / whole
        before = np.concatenate([_pairs(b[2], b[3], b[4][END]) for b in batches])
        flat = np.concatenate([b[3] for b in batches])
        both, number = np.unique(before * len(words) + flat, return_inverse=True)
        a, b = np.divmod(both, len(words))
        places, keys = _bucket_and_key(pair_hashes(hashes[a], hashes[b]), buckets)
        level = np.zeros(len(both), np.int64)
        for bucket, own in split_by(places):
            own = own[np.argsort(keys[own], kind="stable")]
            level[own] = np.asarray(replies[bucket].column("level").values)
        seen = np.minimum(count_of(level), np.minimum(counts[a], counts[b]))
        smooth = np.log10((seen + PAIR_PRIOR * chance[b]) / (counts[a] + PAIR_PRIOR))[number]
        out, done = [], 0
        for ids, _, cuts, flat, _ in batches:
            own = smooth[done : done + len(flat)]
            done += len(flat)
            add = lambda values: np.add.reduceat(values, cuts[:-1]) if len(ids) else values
            out.append(pa.RecordBatch.from_pydict({
                "id": ids, "n_tokens": np.diff(cuts),
                "n_known": add((counts[flat] > 0).astype(np.int64)),
                "train_tokens": np.full(len(ids), total, np.int64),
                "base_score": add(np.log10(chance)[flat]), "score": add(own),
            }))
        return pa.Table.from_batches(out)

    columns = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    done = packed.groupBy("part").cogroup(model.answers.groupBy("part")).applyInArrow(
        scored, f"id bigint, {columns}"
    )
    return done.withColumnRenamed("id", id_column)
