"""Near-duplicates among embeddings: tile products of quantised vectors, exact where in doubt.

Vectors of one label are dealt into blocks, and every two blocks meet once as a tile.  In
a tile the unit vectors are rounded to multiples of an own step, -127 to 127 of them, and
multiplied as whole numbers.  The length of what rounding left off is known per vector and
bounds the error of every product from above: a pair whose bound stays below the threshold
is no link, one whose product is above it by more than the bound is one, and only pairs in
between are computed again from the full vectors in double precision.

A tile gives a number of links per vector and a spanning forest, never its pairs, so a
group of near-copies of any size sends on no more rows than it has vectors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import spanning_links
from ledgerloom.llm.packing import lean_memory
from ledgerloom.operators.graph import connected_components
from ledgerloom.operators.skew import skew_safe_join
from ledgerloom.session import reliable_checkpoint, shuffle_width

THRESHOLD = 0.98
STEPS = 127
# A block holds about so many vectors, and fewer where their components take more bytes.
BLOCK_ROWS, BLOCK_BYTES = 1 << 14, 32 << 20
# Rows and columns of the part of a tile that is multiplied at once.
PART_ROWS = 1024
# Components multiplied at once: sums of so many products of steps are exact in 24 bits.
EXACT_WIDTH = (1 << 24) // STEPS**2
# Above the error of scaling a sum in single precision and of norms in double, for every
# EXACT_WIDTH components.
ROUNDING = 4e-6
# Pairs computed again at once, by the bytes of their vectors; and the share of a part's
# pairs above which all of its products are made again.
RECHECK_BYTES, DENSE_SHARE = 16 << 20, 1 / 32
TILE = "node bigint, links bigint, other bigint"
_TILE_ARROW = pa.schema([(name, pa.int64()) for name in ("node", "links", "other")])


class Quantised:
    """Vectors (rows) as whole steps, with each one's step and the length of its rounding error."""

    def __init__(self, vectors: np.ndarray):
        # By a power of two, so nothing is rounded and no square leaves the range.
        self.full = np.ldexp(vectors.astype(np.float64), -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.full, self.full))
        unit = self.full / self.norm[:, None]
        self.step = np.abs(unit).max(axis=1) / STEPS
        whole = np.rint(unit / self.step[:, None])
        left = unit - whole * self.step[:, None]
        self.error = np.sqrt(np.einsum("ij,ij->i", left, left))
        # Eight-bit numbers, held in single precision: their products are exact there.
        self.codes = whole.astype(np.int8).astype(np.float32)
        self.single_step, self.single_error = self.step.astype(np.float32), self.error.astype(np.float32)


def products(a: Quantised, b: Quantised, rows: slice, columns: slice) -> np.ndarray:
    """Dot products of the rounded unit vectors; whole-number sums, then one scaling."""
    x, y = a.codes[rows], b.codes[columns]
    total = x[:, :EXACT_WIDTH] @ y[:, :EXACT_WIDTH].T
    for at in range(EXACT_WIDTH, x.shape[1], EXACT_WIDTH):
        total += x[:, at : at + EXACT_WIDTH] @ y[:, at : at + EXACT_WIDTH].T
    total *= a.single_step[rows, None]
    total *= b.single_step[None, columns]
    return total


def cosines(a: Quantised, b: Quantised, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosine of the full vectors ``i`` and ``j`` in double precision."""
    out = np.empty(len(i))
    size = max(1, RECHECK_BYTES // (16 * a.full.shape[1]))
    for at in range(0, len(i), size):
        p, q = i[at : at + size], j[at : at + size]
        out[at : at + size] = np.einsum("ij,ij->i", a.full[p], b.full[q]) / (a.norm[p] * b.norm[q])
    return out


def linked(
    a: Quantised, b: Quantised, rows: slice, columns: slice, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row numbers in ``a`` and ``b``) of a part with a cosine of at least ``threshold``."""
    near = products(a, b, rows, columns)
    # (u + du)(v + dv) - uv <= |du| + |dv| + |du||dv| for unit vectors.
    more = a.single_error[rows, None], b.single_error[None, columns]
    reach = more[0] + more[1]
    reach += more[0] * more[1]
    reach += np.float32(ROUNDING * -(-a.codes.shape[1] // EXACT_WIDTH))
    near -= np.float32(threshold)
    possible = near >= -reach
    i, j = np.nonzero(possible)
    if not len(i):
        return i, j
    sure = near[i, j] > reach[i, j]
    doubt = np.flatnonzero(~sure)
    if len(doubt) > DENSE_SHARE * near.size:
        again = a.full[rows] @ b.full[columns].T
        again /= a.norm[rows, None]
        again /= b.norm[None, columns]
        sure[doubt] = again[i[doubt], j[doubt]] >= threshold
    else:
        sure[doubt] = cosines(a, b, i[doubt] + rows.start, j[doubt] + columns.start) >= threshold
    return i[sure] + rows.start, j[sure] + columns.start


class Forest:
    """Classes of rows that links join; the smallest row number names a class."""

    def __init__(self, rows: int):
        self.root = np.arange(rows)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        apart = a != b
        if apart.any():
            moved, to = spanning_links(a[apart], b[apart])
            renamed = np.arange(len(self.root))
            renamed[moved] = to
            self.root = renamed[self.root]


def _parts(rows: int) -> list[slice]:
    return [slice(at, min(at + PART_ROWS, rows)) for at in range(0, rows, PART_ROWS)]


def tile_links(
    left: Quantised, right: Quantised | None, left_copies: np.ndarray, right_copies: np.ndarray,
    threshold: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Links of every vector of a tile to copies of others, and the root of each one's class.

    Rows of ``right`` are numbered after those of ``left``.  Without ``right`` the vectors
    of ``left`` are compared with each other.
    """
    n = len(left.norm)
    other = left if right is None else right
    copies = left_copies if right is None else np.concatenate([left_copies, right_copies])
    shift = 0 if right is None else n
    links, forest = np.zeros(len(copies), np.int64), Forest(len(copies))
    for rows in _parts(n):
        for columns in _parts(len(other.norm)):
            if right is None and columns.start < rows.start:
                continue
            a, b = linked(left, other, rows, columns, threshold)
            if right is None and columns.start == rows.start:
                a, b = a[a < b], b[a < b]
            if len(a):
                b = b + shift
                # Sums of numbers of rows: exact in doubles.
                links += np.bincount(a, copies[b], len(copies)).astype(np.int64)
                links += np.bincount(b, copies[a], len(copies)).astype(np.int64)
                forest.join(a, b)
    return links, forest.root


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return np.asarray(lists.flatten()).reshape(len(lists), -1)


def compare_tile(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """Rows (node, links, null) for vectors with links and (node, null, other) for a forest."""

    def compare(tile: pa.Table) -> pa.Table:
        lean_memory()
        node, copies = (np.asarray(tile.column(name)) for name in ("node", "copies"))
        second = np.asarray(tile.column("second"))
        one = tile.column("low")[0].as_py() == tile.column("high")[0].as_py()
        sides = np.flatnonzero(~second), np.flatnonzero(second)
        vectors = _matrix(tile.column("vector"))
        if one or not len(sides[0]) or not len(sides[1]):
            order = np.arange(len(node)) if one else np.empty(0, np.int64)
            left, right = vectors[order], None
        else:
            order = np.concatenate(sides)
            left, right = vectors[sides[0]], Quantised(vectors[sides[1]])
        if not len(order):
            return pa.Table.from_batches([], _TILE_ARROW)
        node, copies, cut = node[order], copies[order], len(left)
        links, root = tile_links(Quantised(left), right, copies[:cut], copies[cut:], threshold)
        found, moved = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(root)))
        none = lambda n: pa.nulls(n, pa.int64())
        rows = [
            pa.record_batch([pa.array(node[found]), pa.array(links[found]), none(len(found))], _TILE_ARROW),
            pa.record_batch([pa.array(node[moved]), none(len(moved)), pa.array(node[root[moved]])], _TILE_ARROW),
        ]
        return pa.Table.from_batches(rows, _TILE_ARROW)

    return compare


def comparable(vector: Column) -> Column:
    """Whether a vector has a direction: finite components, not all zero, none null."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _tiles(nodes: DataFrame, block_rows: int) -> DataFrame:
    """Every vector once per tile of its block: with each block of its label, itself included."""
    fits = F.greatest(F.lit(1), F.least(F.lit(block_rows), F.floor(F.lit(BLOCK_BYTES) / (4 * F.col("width")))))
    sizes = nodes.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n"))
    # Written first, so that its true size decides whether it is broadcast.
    blocks = reliable_checkpoint(
        sizes.select("label", "width", F.ceil(F.col("n") / fits).alias("blocks")).filter("blocks > 1")
    )
    dealt = nodes.join(blocks, ["label", "width"], "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1).cast("bigint"))
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    met = dealt.withColumn("block", block).withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(
        "label", "width", F.least("block", "met").alias("low"), F.greatest("block", "met").alias("high"),
        (F.col("block") > F.col("met")).alias("second"), "node", "copies", "vector",
    )


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label", threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per vector row: id, ``n_links``, ``component_id``, ``kept``.

    Two rows are linked if their labels are equal and the cosine of their vectors is at
    least ``threshold``; ``component_id`` is the smallest id that links reach, and ``kept``
    says that it is the row's own.  Rows with a null label, and vectors that are null,
    empty, zero, or hold a null or non-finite component, are linked with nothing, as are
    vectors of different lengths.  Equal vectors of a label are compared once and count as
    often as they occur.  Repeated ids are rows like any other.  A null id is never the
    smallest unless a component has no other; it is then kept.  No other column is read.
    """
    rows = vectors.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector")
    )
    able = comparable(F.col("vector")) & F.col("label").isNotNull()
    distinct = rows.filter(able).groupBy("label", "vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")
    )
    nodes = reliable_checkpoint(
        distinct.withColumns({"width": F.size("vector"), "node": F.monotonically_increasing_id()})
    )
    keys = ["label", "width", "low", "high"]
    # A fixed number of partitions: tiles are few bytes and much work, so none may be merged.
    tiles = _tiles(nodes, block_rows).repartition(shuffle_width(vectors.sparkSession), *keys)
    found = reliable_checkpoint(tiles.groupBy(*keys).applyInArrow(compare_tile(threshold), TILE))
    classes = connected_components(
        found.filter("other IS NOT NULL").select(F.col("node").alias("src"), F.col("other").alias("dst"))
    )
    totals = found.filter("links IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(totals, "node", "left").join(classes, "node", "left").select(
        "label", "vector", "least", F.coalesce("component", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    described = skew_safe_join(named, smallest, ["root"]).select("label", "vector", "n_links", "component_id")
    linked_rows = skew_safe_join(rows.filter(able), described, ["label", "vector"]).select(
        "id", "n_links", "component_id"
    )
    alone = rows.filter(~able).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked_rows.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
