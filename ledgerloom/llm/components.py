"""Connected components of links between whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.packing import compact_checkpoint

MAX_ROUNDS = 60
# Links contracted at once inside a task.
BATCH_LINKS = 1 << 18


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node) of the components of the given links."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of a task by as few, with bounded memory."""

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"u": pa.array(a, pa.int64()), "v": pa.array(b, pa.int64())})

    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, np.asarray(batch.column(0))])
        b = np.concatenate([b, np.asarray(batch.column(1))])
        if len(a) >= BATCH_LINKS:
            a, b = spanning_links(a, b)
            if len(a) >= BATCH_LINKS // 2:
                yield out(a, b)
                a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(a):
        yield out(*spanning_links(a, b))


def _pointing(links: DataFrame) -> DataFrame:
    return (
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u <> v").distinct()
    )


def _round(links: DataFrame) -> DataFrame:
    """Large-star, then small-star (Kiveris et al., 2014)."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = _pointing(
        both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    linked = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _pointing(linked.unionByName(least.select("u", F.col("m").alias("v"))))


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u")))
        .first()
    )


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node but the roots: the smallest node it reaches.

    ``links`` has two BIGINT columns.  Every task first contracts its own links to a
    forest; each round is then one table in the checkpoint folder and one row read back.
    """
    pairs = links.toDF("u", "v")
    current = compact_checkpoint(_pointing(pairs.mapInArrow(_contract, "u bigint, v bigint")))
    before = _fingerprint(current)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        current = compact_checkpoint(_round(current))
        after = _fingerprint(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
