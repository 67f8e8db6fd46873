"""Byte-level BPE through one global shuffle of distinct words, and decoding.

Documents are dealt into groups.  Each group cuts its texts into pre-tokens and sends
every distinct one once to the bucket of its hash; a bucket encodes each distinct word
once, whoever sent it, and answers with the ids in the order asked.  Back in the group the
pre-tokens are cut again and the ids are put together by position.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.packing import (
    PACKED, lean_memory, pack, packed_documents, packed_table, split_by, unpack,
)
from ledgerloom.session import shuffle_width

# Groups of documents per shuffle partition: a group's distinct words are held in memory.
GROUPS_PER_PARTITION = 3


class _Numbers(dict):
    """Numbers words in the order they first come up."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64, space, id per line)."""
    pairs = (line.split() for line in raw.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


@lru_cache(maxsize=2)
def _encoder(raw: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=parse_ranks(raw), special_tokens={}
    )


@lru_cache(maxsize=2)
def _token_bytes(raw: bytes) -> pa.Array:
    ranks = parse_ranks(raw)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


def _buckets(words: list[str], buckets: int) -> np.ndarray:
    hashes = (xxhash.xxh64_intdigest(word.encode()) for word in words)
    return (np.fromiter(hashes, np.uint64, len(words)) % np.uint64(buckets)).astype(np.int32)


def _list_offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _offsets(array: pa.Array) -> np.ndarray:
    """Byte offsets of a large binary array."""
    return np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)


def joined_tokens(ids: pa.Array, table: pa.Array) -> pa.Array:
    """Per list of ids the bytes of its tokens, joined; null for a null list."""
    filled = ids.fill_null([]) if ids.null_count else ids
    tokens = table.take(filled.flatten())
    cuts = _offsets(tokens)[_list_offsets(np.asarray(filled.value_lengths()))]
    data = tokens.buffers()[2] or pa.py_buffer(b"")
    buffers = [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), data]
    joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), buffers).cast(pa.binary())
    if not ids.null_count:
        return joined
    return pc.if_else(ids.is_null(), pa.scalar(None, pa.binary()), joined)


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id",
    text_column: str = "text", decode: bool = False,
) -> DataFrame:
    """One row per document row: its id (BIGINT) and ``ids`` (array of token ids).

    With ``decode`` the ids are decoded again in the same task, as ``decode_documents``
    does, into ``decoded``; that saves a second Python process per task.
    Null and empty texts have an empty array; repeated rows and null ids stay as they are.
    The rank file is read once here and sent to the workers; its size is that of the
    vocabulary, whatever the data.
    """
    buckets = shuffle_width(docs.sparkSession)
    groups = GROUPS_PER_PARTITION * buckets
    with open(ranks_path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    packed = packed_documents(docs, id_column, text_column, groups)

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        lean_memory()
        cut = regex.compile(pattern)
        words: set[str] = set()
        for blob in table["blob"].to_pylist():
            for text in unpack(blob).column("text").to_pylist():
                words.update(cut.findall(text or ""))
        ordered = sorted(words)
        asked = pa.array(ordered, pa.string())
        return packed_table(
            (bucket, key[0].as_py(), pack({"word": asked.take(pa.array(rows))}))
            for bucket, rows in split_by(_buckets(ordered, buckets))
        )

    def encode(key: tuple, table: pa.Table) -> pa.Table:
        lean_memory()
        encoder = _encoder(ranks.value, pattern)
        known: dict[str, list[int]] = {}
        answers = []
        for origin, blob in zip(table["origin"].to_pylist(), table["blob"].to_pylist()):
            ids = []
            for word in unpack(blob).column("word").to_pylist():
                if word not in known:
                    known[word] = encoder._encode_single_piece(word)
                ids.append(known[word])
            answer = pack({"ids": pa.array(ids, pa.list_(pa.int32()))})
            answers.append((origin, key[0].as_py(), answer))
        return packed_table(answers)

    def reassemble(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        lean_memory()
        cut = regex.compile(pattern)
        numbers = _Numbers()
        names, positions, sizes = [], [], []
        for blob in table["blob"].to_pylist():
            batch = unpack(blob)
            names.append(batch.column("id"))
            for text in batch.column("text").to_pylist():
                found = cut.findall(text or "")
                sizes.append(len(found))
                positions.append(
                    np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
                )
        words = list(numbers)
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        dealt = _buckets([words[i] for i in order], buckets)
        replies = dict(zip(answers["origin"].to_pylist(), answers["blob"].to_pylist()))
        parts, places = [pa.array([], pa.list_(pa.int32()))], [np.array([], np.int64)]
        for bucket, rows in split_by(dealt):
            parts.append(unpack(replies[bucket]).column("ids"))
            places.append(order[rows])
        codes = pa.concat_arrays(parts)
        where = np.empty(len(words), np.int64)
        place = np.concatenate(places)
        where[place] = np.arange(len(place))
        flat = np.concatenate([np.array([], np.int32), *positions])
        joined = codes.take(pa.array(where[flat]))
        starts = np.asarray(joined.offsets)[_list_offsets(np.array(sizes, np.int64))]
        values = joined.values
        out = pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), values)
        found = {"id": pa.chunked_array(names, pa.int64()), "ids": out.cast(pa.list_(pa.int32()))}
        if decode:
            found["decoded"] = joined_tokens(found["ids"], _token_bytes(ranks.value))
        return pa.table(found)

    asked = packed.groupBy("part").applyInArrow(ask, PACKED)
    answered = asked.groupBy("part").applyInArrow(encode, PACKED)
    encoded = (
        packed.groupBy("part")
        .cogroup(answered.groupBy("part"))
        .applyInArrow(
            reassemble, "id bigint, ids array<int>" + (", decoded binary" if decode else "")
        )
    )
    return encoded.withColumnRenamed("id", id_column)


def decode_documents(encoded: DataFrame, ranks_path: str, ids_column: str = "ids") -> DataFrame:
    """The same rows with ``decoded`` (binary): the token bytes of the ids, joined.

    The token-byte table is broadcast; it has one entry per id of the vocabulary.
    A null array decodes to null.
    """
    with open(ranks_path, "rb") as file:
        ranks = encoded.sparkSession.sparkContext.broadcast(file.read())

    @F.arrow_udf("binary")
    def joined(ids: pa.Array) -> pa.Array:
        return joined_tokens(ids, _token_bytes(ranks.value))

    return encoded.withColumn("decoded", joined(F.col(ids_column)))
