"""Which stretches of documents also start earlier: windows dealt out by their minimisers.

A window is a fixed number of units (words, bytes) of one document.  Its minimiser is the
gram with the smallest hash in it; grams that hold more than a bucket's share of the data
rank last, so no common phrase draws a bucket's worth of windows.  Consecutive windows that
share one minimiser make a stretch, and a stretch travels as one packed string to the
bucket of its minimiser.  Equal windows have equal minimisers at equal places, so they
always meet; and no two windows of one stretch are equal.

Steps, each a Spark shuffle of packed rows:

1. gram frequencies, to rank the common grams last (a bitmap of fixed size);
2. every group of documents asks which of its minimisers occur more than once;
3. stretches around those travel to buckets; equal stretches of one group travel once;
4. a bucket decides which windows are not the first of their kind, by the method of the
   operator, and sends spans back;
5. every group removes the spans from its documents.

Documents are ordered by id (null first), then by text hash where an id repeats; rows with
one id and one text count as one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.packing import (
    PACKED, group_count, id_values, lean_memory, mixed, pack, packed_documents, packed_table,
    row_groups, split_by, unpack,
)

# Bytes of text worked on at once.  A longer document is cut into pieces that overlap by a
# window less one unit: every window lies in one piece.
BLOCK_BYTES = 1 << 20
SLOT_BITS = 20
# A gram slot is common above this part of one group's share of all grams, and never below
# 2**-17 of them: the bitmap tells 2**20 slots apart.
SHARE_OF_GROUP = 1 / 64
LEAST_SHARE = 2.0**-17
# Bits of a hash that a group sends to ask whether it occurs elsewhere.  A false yes only
# sends a stretch in vain.
ASK_BITS = 40
_BASE = 0x9E3779B97F4A7C15
_PLACE_BITS = 24

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base modulo 2**64, and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = []
        for base in (_BASE, inverse):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(units: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes (one more than there are units)."""
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers(len(units))[0], out=sums[1:])
    return sums


def range_hashes(prefix: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Hashes of ranges; equal ranges have equal hashes wherever they stand."""
    return (prefix[start + length] - prefix[start]) * powers(len(prefix))[1][start]


@dataclass
class Block:
    """Units of some documents, or pieces of them, one after the other."""

    data: bytes
    starts: np.ndarray  # of units in the data
    ends: np.ndarray
    hashes: np.ndarray  # of units
    first: np.ndarray  # first unit of each document, and the number of units
    rows: np.ndarray  # which of the given texts each document is
    before: np.ndarray  # units of the document that stand before the piece


@dataclass
class Units:
    """What a window is made of."""

    window: int
    gram: int
    # The pieces of a document as a block takes them, each with the units before it; none
    # if it holds no window.
    pieces: Callable[[bytes], list[tuple[int, bytes]]]
    block: Callable[[list[bytes], list[int], list[int]], Block]

    def blocks(self, texts: pa.Array) -> Iterator[Block]:
        """Blocks of the documents that hold a window."""
        data, rows, before, size = [], [], [], 0
        for row, text in enumerate(texts.cast(pa.binary()).to_pylist()):
            for skipped, raw in self.pieces(text or b""):
                if data and size + len(raw) > BLOCK_BYTES:
                    yield self.block(data, rows, before)
                    data, rows, before, size = [], [], [], 0
                data.append(raw)
                rows.append(row)
                before.append(skipped)
                size += len(raw)
        if data:
            yield self.block(data, rows, before)


def gram_hashes(block: Block, gram: int) -> np.ndarray:
    prefix = prefix_hashes(block.hashes)
    start = np.arange(len(block.hashes) - gram + 1)
    return mixed((prefix[gram:] - prefix[:-gram]) * powers(len(prefix))[1][: len(start)])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in log(width) passes."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


@dataclass
class Stretches:
    """Stretches of a block, without its units."""

    data: bytes
    low: np.ndarray  # bytes from low to high
    high: np.ndarray
    row: np.ndarray  # which text
    start: np.ndarray  # first unit in the document
    windows: np.ndarray
    place: np.ndarray  # of the minimiser, from the first unit
    hash: np.ndarray  # of the minimiser


def stretches(block: Block, units: Units, common: np.ndarray) -> Stretches:
    grams = gram_hashes(block, units.gram)
    place = np.arange(len(grams), dtype=np.uint64)
    rank = grams >> np.uint64(1) | common[grams >> np.uint64(64 - SLOT_BITS)].astype(np.uint64) << np.uint64(63)
    # Ties go to the first place, in every copy alike.
    bits = np.uint64(max(_PLACE_BITS, int(len(grams)).bit_length()))
    least = sliding_least((rank >> bits) << bits | place, units.window - units.gram + 1)
    valid = np.zeros(len(least), bool)
    for start, end in zip(block.first[:-1], block.first[1:]):
        valid[start : end - units.window + 1] = True
    begins = valid.copy()
    begins[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    ends = valid.copy()
    ends[:-1] &= (least[1:] != least[:-1]) | ~valid[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    at = (least[first] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    doc = np.searchsorted(block.first, first, side="right") - 1
    return Stretches(
        block.data, block.starts[first], block.ends[last + units.window - 1], block.rows[doc],
        first - block.first[doc] + block.before[doc], last - first + 1, at - first, grams[at],
    )


def common_slots(docs: DataFrame, text_column: str, units: Units, groups: int) -> np.ndarray:
    """Which slots of gram hashes are common, as packed bits.

    A task reports the slots with more than a share of its own grams; the reported counts
    of a slot with twice that share of all grams pass it, and few slots can.
    """
    share = max(SHARE_OF_GROUP / groups, LEAST_SHARE)
    source = docs.select(F.col(text_column).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for block in units.blocks(batch.column("text")):
                slots = gram_hashes(block, units.gram) >> np.uint64(64 - SLOT_BITS)
                counts += np.bincount(slots.astype(np.int64), minlength=len(counts))
        total = int(counts.sum())
        many = np.flatnonzero(counts > share * total)
        yield pa.RecordBatch.from_pydict(
            {"slot": pa.array(np.append(many, -1), pa.int32()),
             "n": pa.array(np.append(counts[many], total), pa.int64())}
        )

    summed = source.mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    found = {row["slot"]: row["n"] for row in summed.collect()}
    total = found.pop(-1, 0)
    common = np.zeros(1 << SLOT_BITS, bool)
    common[[slot for slot, n in found.items() if n > share * total]] = True
    return np.packbits(common)


def _asked(hashes: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in the order they are asked for, their buckets and short keys."""
    buckets = (hashes % np.uint64(groups)).astype(np.int32)
    keys = (hashes // np.uint64(groups)) >> np.uint64(64 - ASK_BITS - max(groups - 1, 1).bit_length())
    keys &= np.uint64((1 << ASK_BITS) - 1)
    order = np.lexsort((hashes, keys, buckets))
    return order, buckets[order], keys[order]


@dataclass
class Occurrences:
    """Stretches that met in a bucket, one entry per distinct place."""

    text: list[bytes]
    windows: np.ndarray  # in each stretch
    id: np.ndarray
    tag: np.ndarray  # text hash, tells rows with one id apart
    start: np.ndarray  # first unit in its document
    place: np.ndarray  # of the minimiser in the stretch, in units
    hash: np.ndarray  # of the minimiser

    def take(self, rows: np.ndarray) -> Occurrences:
        return Occurrences(
            [self.text[i] for i in rows.tolist()],
            *(x[rows] for x in (self.windows, self.id, self.tag, self.start, self.place, self.hash)),
        )

    def ranked(self) -> Occurrences:
        """In document order, each place once (rows with one id and text share theirs)."""
        order = np.lexsort((self.start, self.tag, self.id))
        new = np.ones(len(order), bool)
        new[1:] = False
        for column in (self.start, self.tag, self.id):
            new[1:] |= column[order[1:]] != column[order[:-1]]
        return self.take(order[new])


_STRETCH_COLUMNS = ("text", "windows", "id", "tag", "start", "place", "hash")


def _packed_occurrences(o: Occurrences) -> bytes:
    columns = {"text": pa.array(o.text, pa.large_binary())}
    columns |= {
        name: getattr(o, name) for name in _STRETCH_COLUMNS[1:]
    }
    return pack(columns)


def _unpacked_occurrences(blobs: list[bytes]) -> Occurrences:
    texts: list[bytes] = []
    columns: list[list[np.ndarray]] = []
    for blob in blobs:  # a batch's own copy of the texts goes before the next one comes
        batch = unpack(blob)
        texts += batch.column("text").to_pylist()
        columns.append([np.asarray(batch.column(name)) for name in _STRETCH_COLUMNS[1:]])
    return Occurrences(texts, *(np.concatenate(parts) for parts in zip(*columns)))


def once_each(o: Occurrences) -> tuple[np.ndarray, np.ndarray]:
    """Rows to keep, the first of each equal stretch, and the rows that repeat one.

    ``o`` is in document order.
    """
    seen: set[bytes] = set()
    again = np.zeros(len(o.text), bool)
    for i, text in enumerate(o.text):
        if text in seen:
            again[i] = True
        else:
            seen.add(text)
    return np.flatnonzero(~again), np.flatnonzero(again)


def _spans(o: Occurrences, rows: np.ndarray, first: np.ndarray, last: np.ndarray, window: int):
    """Unit ranges that the windows ``first`` to ``last`` of the given stretches cover."""
    return {
        "id": o.id[rows], "tag": o.tag[rows],
        "start": o.start[rows] + first, "end": o.start[rows] + last + window,
    }


def _whole(o: Occurrences, rows: np.ndarray, window: int) -> dict[str, np.ndarray]:
    return _spans(o, rows, np.zeros(len(rows), np.int64), o.windows[rows] - 1, window)


def _packed_spans(spans: dict[str, np.ndarray], groups: int) -> list[tuple[int, int, bytes]]:
    dealt = row_groups(spans["id"], spans["tag"], groups)
    return [
        (group, 1, pack({name: column[rows] for name, column in spans.items()}))
        for group, rows in split_by(dealt)
    ]


def repeated_windows(o: Occurrences, window: int, repeats: Callable) -> dict[str, np.ndarray]:
    """Spans of the windows of a bucket that are not the first of their kind.

    ``repeats(texts, windows, place, group)`` tells for each window of each stretch, in
    order, whether an equal window comes before it; the stretches come in document order
    and ``group`` numbers their minimisers.
    """
    o = o.ranked()
    kept, again = once_each(o)
    spans = [_whole(o, again, window)]
    o = o.take(kept)
    _, group, sizes = np.unique(o.hash, return_inverse=True, return_counts=True)
    several = np.flatnonzero(sizes[group] > 1)
    if len(several):
        o, group = o.take(several), group[several]
        repeated = repeats(o.text, o.windows, o.place, group)
        begin = np.cumsum(o.windows) - o.windows
        edge = np.zeros(len(repeated), bool)
        edge[begin] = True
        first = np.flatnonzero(repeated & (edge | ~np.concatenate([[False], repeated[:-1]])))
        last = np.flatnonzero(repeated & (np.append(edge[1:], True) | ~np.append(repeated[1:], False)))
        owner = np.searchsorted(begin, first, side="right") - 1
        spans.append(_spans(o, owner, first - begin[owner], last - begin[owner], window))
    return {name: np.concatenate([s[name] for s in spans]) for name in spans[0]}


def find_repeats(
    docs: DataFrame, id_column: str, text_column: str, units: Units, repeats: Callable,
    finish: Callable[[str | None, np.ndarray], tuple], columns: str, groups: int | None = None,
) -> DataFrame:
    """One row per document row: ``id`` and what ``finish`` makes of its text and spans.

    ``finish(text, spans)`` gets the merged unit ranges to remove, in order, and returns
    the values of ``columns``.
    """
    groups = groups or group_count(docs)
    common = docs.sparkSession.sparkContext.broadcast(
        common_slots(docs, text_column, units, groups)
    )
    packed = packed_documents(docs, id_column, text_column, groups)

    def cut(table: pa.Table):
        """(ids, tags, stretches) for the documents of a group."""
        ranks = np.unpackbits(common.value).astype(bool)
        for blob in table["blob"].to_pylist():
            batch = unpack(blob)
            ids, tags = id_values(batch.column("id")), np.asarray(batch.column("hash"))
            for block in units.blocks(batch.column("text")):
                yield ids, tags, stretches(block, units, ranks)

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        lean_memory()
        none = np.empty(0, np.uint64)
        hashes = np.concatenate([none, *(found.hash for *_, found in cut(table))])
        distinct, counts = np.unique(hashes, return_counts=True)
        order, buckets, keys = _asked(distinct, groups)
        twice = counts[order] > 1
        return packed_table(
            (bucket, key[0].as_py(),
             pack({"gap": np.diff(keys[rows], prepend=np.uint64(0)), "twice": twice[rows]}))
            for bucket, rows in split_by(buckets)
        )

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        lean_memory()
        asked = [unpack(blob) for blob in table["blob"].to_pylist()]
        keys = [np.cumsum(np.asarray(b.column("gap")), dtype=np.uint64) for b in asked]
        twice = np.concatenate([b.column("twice").to_numpy(zero_copy_only=False) for b in asked])
        _, number, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        again = np.bincount(number, weights=twice) > 0
        repeated = ((counts > 1) | again)[number]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return packed_table(
            (origin, key[0].as_py(), pack({"bits": np.packbits(part)}))
            for origin, part in zip(table["origin"].to_pylist(), np.split(repeated, cuts))
        )

    def send(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        lean_memory()
        cuts = list(cut(table))
        none = np.empty(0, np.uint64)
        distinct = np.unique(np.concatenate([none, *(found.hash for *_, found in cuts)]))
        order, buckets, _ = _asked(distinct, groups)
        replies = dict(zip(answers["origin"].to_pylist(), answers["blob"].to_pylist()))
        repeated = np.zeros(len(distinct), bool)
        for bucket, rows in split_by(buckets):
            bits = np.unpackbits(np.asarray(unpack(replies[bucket]).column("bits")))
            repeated[order[rows]] = bits[: len(rows)].astype(bool)
        parts = []
        for ids, tags, found in cuts:
            rows = np.flatnonzero(repeated[np.searchsorted(distinct, found.hash)])
            low, high = found.low[rows].tolist(), found.high[rows].tolist()
            parts.append(Occurrences(
                [found.data[a:b] for a, b in zip(low, high)], found.windows[rows],
                ids[found.row[rows]], tags[found.row[rows]], found.start[rows],
                found.place[rows], found.hash[rows],
            ))
        if not parts:
            return packed_table([])
        o = Occurrences(
            [text for part in parts for text in part.text],
            *(np.concatenate([getattr(part, name) for part in parts])
              for name in _STRETCH_COLUMNS[1:]),
        ).ranked()
        kept, again = once_each(o)
        rows = []
        if len(again):
            rows.append((key[0].as_py(), 1, pack(_whole(o, again, units.window))))
        o = o.take(kept)
        for bucket, own in split_by((o.hash % np.uint64(groups)).astype(np.int32)):
            rows.append((bucket, 0, _packed_occurrences(o.take(own))))
        return packed_table(rows)

    def decide(key: tuple, table: pa.Table) -> pa.Table:
        lean_memory()
        kinds, blobs = table["origin"].to_pylist(), table["blob"].to_pylist()
        rows = [(key[0].as_py(), 1, blob) for kind, blob in zip(kinds, blobs) if kind == 1]
        sent = [blob for kind, blob in zip(kinds, blobs) if kind == 0]
        if sent:
            found = repeated_windows(_unpacked_occurrences(sent), units.window, repeats)
            rows += _packed_spans(found, groups)
        return packed_table(rows)

    def remove(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        lean_memory()
        names = ("id", "tag", "start", "end")
        spans = [unpack(blob) for blob in found["blob"].to_pylist()]
        id_, tag, start, end = (
            np.concatenate([np.empty(0, np.uint64 if name == "tag" else np.int64),
                            *(np.asarray(b.column(name)) for b in spans)])
            for name in names
        )
        order = np.lexsort((start, tag, id_))
        id_, tag, start, end = id_[order], tag[order], start[order], end[order]
        edges = np.flatnonzero(
            np.concatenate([[True], (id_[1:] != id_[:-1]) | (tag[1:] != tag[:-1]), [True]])
        ) if len(id_) else np.zeros(1, np.int64)
        own = {
            (int(id_[a]), int(tag[a])): merge_spans(start[a:b], end[a:b])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())
        }
        nothing = np.empty((0, 2), np.int64)
        out = []
        for blob in table["blob"].to_pylist():
            batch = unpack(blob)
            ids = id_values(batch.column("id")).tolist()
            tags = np.asarray(batch.column("hash")).tolist()
            texts = batch.column("text").to_pylist()
            done = [
                finish(text, own.get(row, nothing)) for row, text in zip(zip(ids, tags), texts)
            ]
            values = [list(column) for column in zip(*done)] or [[] for _ in schema.names[1:]]
            arrays = [pa.array(v, f.type) for v, f in zip(values, list(schema)[1:])]
            out.append(pa.RecordBatch.from_arrays([batch.column("id"), *arrays], schema=schema))
        return pa.Table.from_batches(out, schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    declared = f"id bigint, {columns}"
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], declared).schema)
    asked = packed.groupBy("part").applyInArrow(ask, PACKED)
    answered = asked.groupBy("part").applyInArrow(answer, PACKED)
    sent = packed.groupBy("part").cogroup(answered.groupBy("part")).applyInArrow(send, PACKED)
    decided = sent.groupBy("part").applyInArrow(decide, PACKED)
    done = packed.groupBy("part").cogroup(decided.groupBy("part")).applyInArrow(remove, declared)
    return done.withColumnRenamed("id", id_column)


def merge_spans(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ranges sorted by start as maximal disjoint ones; those that touch become one."""
    reach = np.maximum.accumulate(end)
    first = np.concatenate([[True], start[1:] > reach[:-1]])
    last = np.append(first[1:], True)
    return np.stack([start[first], reach[last]], axis=1)
