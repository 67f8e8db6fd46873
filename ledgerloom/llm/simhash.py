"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into fewer segments than an exact index would need: with at
most ``d`` differing bits and ``d // 2 + 1`` segments, one segment differs in at most one
bit.  Every segment is indexed once per bit with that bit left out, so two segments at
most one bit apart meet under an equal key.  Fingerprints that meet are compared in full.

Only distinct fingerprints are indexed, so exact copies cost nothing, and of the links
found under one key only a spanning forest is kept, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import smallest_reachable, spanning_links
from ledgerloom.llm.packing import compact_checkpoint, row_key
from ledgerloom.session import shuffle_width

BITS = 64
SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
# Hashes whose bits are counted at once; bounds the memory a long text takes.
HASH_BLOCK = 1 << 16
# Fingerprints under one key compared in one place; more are compared block by block.
KEY_BLOCK = 2048
# Keys with up to so many fingerprints are compared together, longer ones each by itself.
SHORT_RUN = 32


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash over word shingles, repeats included; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    first, last = starts.tolist(), ends[shingle_words - 1 :].tolist() or [len(joined)]
    total, ones = len(last), np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, HASH_BLOCK):
        spans = zip(first[at : at + HASH_BLOCK], last[at : at + HASH_BLOCK])
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > total, bitorder="little").view("<u8")[0]
    return int(value)


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS, *others: str,
) -> DataFrame:
    """``id`` and ``fp`` (the fingerprint as BIGINT) of every document row, and ``others``."""

    @F.arrow_udf("bigint")
    def compute(texts: pa.Array) -> pa.Array:
        values = (fingerprint(text, shingle_words) for text in texts.to_pylist())
        return pa.array(np.fromiter(values, np.uint64, len(texts)).view(np.int64))

    return docs.select(
        F.col(id_column).cast("bigint").alias("id"), compute(F.col(text_column)).alias("fp"), *others
    )


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments: so many that one differs in at most one bit."""
    count = max_bits // 2 + 1
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(low, high - low) for low, high in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    """A 64-bit mask as Spark's signed BIGINT."""
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def variant_keys(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``bit``, ``rest`` and ``fp``: one row per fingerprint and left-out bit.

    ``rest`` is the segment that holds the bit, with the bit cleared.
    """
    variants = []
    for low, width in segments(max_bits):
        segment = F.shiftrightunsigned(F.col("fp"), low)
        for bit in range(low, low + width):
            rest = segment.bitwiseAND(F.lit(_signed((1 << width) - 1 ^ 1 << (bit - low))))
            variants.append(F.struct(F.lit(bit).alias("bit"), rest.alias("rest")))
    return distinct.select(F.explode(F.array(*variants)).alias("k"), "fp").select("k.*", "fp")


def forest(values: np.ndarray, others: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what the close pairs between the two sets connect.

    The sets may be one and the same.  Breadth first: a value once reached is never
    compared again, so there are fewer links than values.
    """
    same = values is others
    waiting = [values, values if same else others]  # not reached yet, by side
    left = [np.ones(len(values), bool), np.ones(len(others), bool)]
    if same:
        left[1] = left[0]
    links: list[tuple[int, int]] = []
    for start in range(len(values)):
        if not left[0][start]:
            continue
        left[0][start] = False
        queue = [(0, start)]
        while queue:
            side, at = queue.pop()
            other = 1 - side
            rest = np.flatnonzero(left[other])
            if not len(rest):
                continue
            near = rest[
                np.bitwise_count(waiting[other][rest] ^ waiting[side][at]) <= max_bits
            ]
            left[other][near] = False
            source = int(waiting[side][at])
            for i in near.tolist():
                links.append((source, int(waiting[other][i])))
                queue.append((other, i))
    return links


def _key_links(bit: int, fps: np.ndarray, first: bool, max_bits: int) -> list:
    """Links among the fingerprints under one key.

    Equal segments meet under every bit of the segment; they are compared under its first
    bit only.  Under the other bits only fingerprints that differ in the bit are compared.
    """
    if first:
        return forest(fps, fps, max_bits)
    set_ = (fps >> np.uint64(bit)) & np.uint64(1) != 0
    return forest(fps[set_], fps[~set_], max_bits) if set_.any() and not set_.all() else []


def _first_bits(max_bits: int) -> set[int]:
    return {low for low, _ in segments(max_bits)}


LINKS = "bit int, rest bigint, block int, a bigint, b bigint"
_LINKS_ARROW = pa.schema(
    [("bit", pa.int32()), ("rest", pa.int64()), ("block", pa.int32()), ("a", pa.int64()),
     ("b", pa.int64())]
)


def _small_links(
    bits: np.ndarray, fps: np.ndarray, run: np.ndarray, firsts: np.ndarray, most: int,
    max_bits: int,
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside short runs of equal keys, without a loop per key."""
    found_a, found_b = [], []
    for step in range(1, most):
        a, b = fps[:-step], fps[step:]
        apart = (a ^ b) >> bits[step:].astype(np.uint64) & np.uint64(1) != 0
        near = (run[:-step] == run[step:]) & (apart | firsts[step:])
        near &= np.bitwise_count(a ^ b) <= max_bits
        found_a.append(a[near])
        found_b.append(b[near])
    none = np.empty(0, np.uint64)
    return spanning_links(np.concatenate([none, *found_a]), np.concatenate([none, *found_b]))


def links_under_keys(keys: DataFrame, max_bits: int, block: int = KEY_BLOCK) -> DataFrame:
    """Links (``a``, ``b``) that connect what the close pairs under all keys connect.

    Rows are sorted by key and read in order; a key's rows are compared as they pass.  A
    key with more than ``block`` fingerprints is passed on in numbered blocks, which are
    then compared pair by pair, each pair of blocks in a group of its own.
    """
    first_bits = np.array(sorted(_first_bits(max_bits)))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64)]
        passed: list = [None, 0]  # key that has grown beyond a block, blocks passed on

        def emit(bits, rests, blocks, a, b) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(x), t) for x, t in
                 zip((bits, rests, blocks, a, b), _LINKS_ARROW.types)], schema=_LINKS_ARROW
            )

        def pass_on(bit, rest, fps):
            for at in range(0, len(fps), block):
                part = fps[at : at + block].view(np.int64)
                n = len(part)
                yield emit(np.full(n, bit), np.full(n, rest), np.full(n, passed[1]), part, part)
                passed[1] += 1

        def closed(bits, rests, fps):
            """Rows whose keys are complete."""
            if passed[0] is not None:
                # The end of a key whose blocks went on belongs to them, however short.
                more = (bits == passed[0][0]) & (rests == passed[0][1])
                yield from pass_on(*passed[0], fps[more])
                bits, rests, fps = bits[~more], rests[~more], fps[~more]
            if not len(bits):
                return
            new = np.concatenate([[True], (bits[1:] != bits[:-1]) | (rests[1:] != rests[:-1])])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.concatenate([starts, [len(bits)]]))
            run = np.repeat(np.arange(len(starts)), sizes)
            own = np.repeat(sizes, sizes)
            short = (own > 1) & (own <= SHORT_RUN)
            a, b = _small_links(
                bits[short], fps[short], run[short], np.isin(bits[short], first_bits),
                int(own[short].max(initial=0)), max_bits,
            )
            found = []
            long = sizes > SHORT_RUN
            for start, size in zip(starts[long].tolist(), sizes[long].tolist()):
                bit, rest = int(bits[start]), int(rests[start])
                own = fps[start : start + size]
                if size > block:
                    passed[:] = [(bit, rest), 0]
                    yield from pass_on(bit, rest, own)
                else:
                    found += _key_links(bit, own, bit in first_bits, max_bits)
            many = np.array(found, np.uint64).reshape(-1, 2)
            a, b = np.concatenate([a, many[:, 0]]), np.concatenate([b, many[:, 1]])
            if len(a):
                none = np.full(len(a), -1)
                yield emit(none, none, none, a.view(np.int64), b.view(np.int64))

        for batch in batches:
            fresh = [np.asarray(batch.column(0)), np.asarray(batch.column(1)),
                     np.asarray(batch.column(2)).view(np.uint64)]
            bits, rests, fps = (np.concatenate(x) for x in zip(held, fresh))
            if not len(bits):
                continue
            # The last key may go on in the next batch.
            same = (bits == bits[-1]) & (rests == rests[-1])
            cut = len(bits) - int(np.argmin(same[::-1])) if not same.all() else 0
            yield from closed(bits[:cut], rests[:cut], fps[:cut])
            held = [bits[cut:], rests[cut:], fps[cut:]]
            if len(held[0]) > block:
                key = (int(bits[-1]), int(rests[-1]))
                if passed[0] != key:
                    passed[:] = [key, 0]
                whole = len(held[2]) // block * block
                yield from pass_on(*key, held[2][:whole])
                held = [column[whole:] for column in held]
        yield from closed(*held)

    dealt = keys.repartition(shuffle_width(keys.sparkSession), "bit", "rest")
    found = compact_checkpoint(
        dealt.sortWithinPartitions("bit", "rest").mapInArrow(stream, LINKS)
    )
    blocks = found.filter("block >= 0")
    counts = blocks.groupBy("bit", "rest").agg((F.max("block") + 1).alias("blocks"))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = (
        blocks.join(counts, ["bit", "rest"]).withColumn("partner", partner)
        .select(
            "bit", "rest", F.least("block", "partner").alias("low"),
            F.greatest("block", "partner").alias("high"), "block", F.col("a").alias("fp"),
        )
    )

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        bit, _, low, high = (x.as_py() for x in key)
        fps = np.asarray(table["fp"]).view(np.uint64)
        own = np.asarray(table["block"])
        left, right = fps[own == low], fps[own == high]
        if low == high:
            found = _key_links(bit, left, bit in first_bits, max_bits)
        elif bit in first_bits:
            found = forest(left, right, max_bits)
        else:
            split = lambda x: (x >> np.uint64(bit)) & np.uint64(1) != 0
            found = forest(left[split(left)], right[~split(right)], max_bits)
            found += forest(left[~split(left)], right[split(right)], max_bits)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    far = spread.groupBy("bit", "rest", "low", "high").applyInArrow(compare, "a bigint, b bigint")
    return found.filter("block < 0").select("a", "b").unionByName(far)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block: int = KEY_BLOCK,
) -> DataFrame:
    """One row per document row: id, ``fp`` and ``component_id``.

    Two fingerprints are linked at ``max_bits`` or fewer differing bits; the component id
    is the smallest id that links reach.  Texts without words have fingerprint 0 and are
    linked like any other; repeated rows and equal texts share a fingerprint.  A null id
    is never the smallest, unless a component has no other.
    """
    prints = compact_checkpoint(fingerprints(docs, id_column, text_column, shingle_words))
    classes = _classes(prints, max_bits, block)
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_column), "fp", "component_id"
    )


def _classes(prints: DataFrame, max_bits: int, block: int = KEY_BLOCK) -> DataFrame:
    """``fp``, ``root`` (one of the fingerprints it reaches) and ``component_id``."""
    distinct = compact_checkpoint(prints.groupBy("fp").agg(F.min("id").alias("least")))
    links = links_under_keys(variant_keys(distinct.select("fp"), max_bits), max_bits, block)
    roots = smallest_reachable(links)
    labelled = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return labelled.join(smallest, "root").select("fp", "root", "component_id")


def keep_one_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """The row of ``docs`` with the smallest id of each group of near-duplicates.

    Exactly one row of a group is kept: of rows that share the smallest id, or have no id
    where their group has no other, the one whose text has the smallest hash, and of rows
    with one id and one text, any.
    """
    keyed = docs.withColumn("__row", row_key(id_column, text_column))
    prints = compact_checkpoint(fingerprints(keyed, id_column, text_column, shingle_words, "__row"))
    classes = _classes(prints, max_bits)
    least = prints.groupBy("fp").agg(F.min("__row").alias("__kept"))
    kept = (
        least.join(classes, "fp").groupBy("root").agg(F.min("__kept").alias("__kept"))
        .select("__kept")
    )
    found = keyed.join(kept, F.col("__row") == F.col("__kept"), "left_semi")
    return found.dropDuplicates(["__row"]).drop("__row")
