"""Packed rows: many small values travel through a shuffle as one compressed column batch.

A packed row is ``(part, origin, blob)``: the group it belongs to, where it came from, and
an Arrow stream compressed with zstd.  Spark still partitions, shuffles and retries the
rows; only their payload is opaque to it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import reliable_checkpoint, shuffle_width

PACKED = "part int, origin int, blob binary"
PACKED_ARROW = pa.schema(
    [("part", pa.int32()), ("origin", pa.int32()), ("blob", pa.binary())]
)
ZSTD_LEVEL = 5
# Groups per shuffle partition: enough that an uneven deal of groups evens out.
GROUPS_PER_PARTITION = 2
# Stands for a null id where ids are compared: nulls sort first, as in Spark.
NULL_ID = np.iinfo(np.int64).min


_trimmed_for = [-1]


def lean_memory() -> None:
    """Let a worker give freed memory back; it is kept for later tasks otherwise.

    One thread, as the task has one core: every further thread would keep memory of its own.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    pa.set_cpu_count(1)
    task = TaskContext.get()
    if task is not None and task.taskAttemptId() != _trimmed_for[0]:
        _trimmed_for[0] = task.taskAttemptId()  # once a task: new pages cost time
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library: freed memory stays with the worker


def pack(columns: dict[str, pa.Array | np.ndarray | list]) -> bytes:
    """Columns of one length as a compressed Arrow stream."""
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(
        compression=pa.Codec("zstd", compression_level=ZSTD_LEVEL), use_threads=False
    )
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(blob: bytes) -> pa.RecordBatch:
    """The columns that ``pack`` wrote."""
    with pa.ipc.open_stream(blob, options=pa.ipc.IpcReadOptions(use_threads=False)) as reader:
        return reader.read_next_batch()


def packed_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """Packed rows as an Arrow batch."""
    part, origin, blob = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(origin, pa.int32()), pa.array(blob, pa.binary())],
        schema=PACKED_ARROW,
    )


def packed_table(rows: Iterable[tuple[int, int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([packed_batch(list(rows))])


def group_count(df: DataFrame) -> int:
    """Number of groups to deal packed rows into; it follows the session's shuffle width."""
    return GROUPS_PER_PARTITION * shuffle_width(df.sparkSession)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers over the 64-bit range (two xor-shift multiply rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def id_values(ids: pa.Array) -> np.ndarray:
    """Ids as BIGINT, null as the smallest one."""
    return np.asarray(ids.cast(pa.int64()).fill_null(NULL_ID))


def text_hashes(texts: pa.Array) -> np.ndarray:
    """64-bit hash of each text; with the id it names a row even where ids repeat."""
    raw = texts.cast(pa.binary()).to_pylist()
    hashes = (0 if text is None else xxhash.xxh64_intdigest(text) for text in raw)
    return np.fromiter(hashes, np.uint64, len(texts))


def row_key(id_column: str, text_column: str) -> Column:
    """Names a row by id and text, as packed documents do, for joins in Spark.

    A struct is compared field by field, null equal to null, so it may be joined on.  Null
    ids come last, and rows without an id spread by their texts.
    """
    return F.struct(
        F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"),
        F.xxhash64(text_column).alias("hash"), F.col(text_column).isNull().alias("empty"),
    )


def row_groups(ids: np.ndarray, hashes: np.ndarray, groups: int) -> np.ndarray:
    """Group of each row: a function of its id and text alone, so a retry deals alike."""
    return (mixed(ids.view(np.uint64) ^ mixed(hashes)) % np.uint64(groups)).astype(np.int32)


def compact_checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint with a file for every few shuffle partitions, at least one per core.

    A task then writes the rows of several partitions, one after the other.
    """
    spark = df.sparkSession
    files = max(spark.sparkContext.defaultParallelism, shuffle_width(spark) // 4)
    return reliable_checkpoint(df.coalesce(files))


def split_by(groups: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(group, row numbers) for every group that occurs."""
    order = np.argsort(groups, kind="stable")
    cuts = np.flatnonzero(np.diff(groups[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(groups[rows[0]]), rows


def packed_documents(
    docs: DataFrame, id_column: str, text_column: str, groups: int, flag: Column | None = None
) -> DataFrame:
    """Documents as packed rows (columns id, text, hash, flag), dealt into ``groups``."""
    source = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"),
        *([] if flag is None else [flag.alias("flag")]),
    )
    names = source.columns

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for batch in batches:
            hashes = text_hashes(batch.column("text"))
            dealt = row_groups(id_values(batch.column("id")), hashes, groups)
            for group, rows in split_by(dealt):
                take = pa.array(rows)
                columns = {name: batch.column(name).take(take) for name in names}
                yield packed_batch([(group, 0, pack({**columns, "hash": hashes[rows]}))])

    return source.mapInArrow(deal, PACKED)
