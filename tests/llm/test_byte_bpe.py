"""Byte-level BPE: the same ids as the library, and an exact round trip."""

import base64

import public_tokenizers
import pytest
import tiktoken

from ledgerloom.llm import byte_bpe
from tests.llm.frames import documents, empty, odd_rows

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_ids_and_round_trip(spark, library):
    rows = odd_rows() + [
        (20, "I'll say 'tis don't we've  \n\n\t x 　 日本語 ١٢٣ <|endoftext|> á"),
        (21, "".join(map(chr, range(0x2FF)))), (22, "   \x85\x1c\x1d  z "), (23, "퟿￿"),
    ]
    encoded = byte_bpe.encode_documents(
        documents(spark, rows, clashes=True), RANKS, public_tokenizers.PATTERN
    )
    got = byte_bpe.decode_documents(encoded, RANKS).collect()
    want = sorted(str((i, library.encode_ordinary(t or ""), (t or "").encode())) for i, t in rows)
    assert sorted(str((r.doc_id, list(r.ids), bytes(r.decoded))) for r in got) == want


def test_decoding_in_the_same_task(spark):
    rows = [(i, f"text number {i} " * i) for i in range(30)] + [(None, None)]
    both = byte_bpe.encode_documents(
        documents(spark, rows), RANKS, public_tokenizers.PATTERN, decode=True
    ).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in both) == sorted(
        (str(i), (t or "").encode()) for i, t in rows
    )


def test_null_ids(spark):
    frame = spark.createDataFrame([(1, [64, 65]), (2, None), (3, [])], "doc_id int, ids array<int>")
    got = {r.doc_id: r.decoded for r in byte_bpe.decode_documents(frame, RANKS).collect()}
    assert got[2] is None and got[3] == b"" and len(got[1]) >= 2


def test_empty(spark):
    assert byte_bpe.encode_documents(empty(spark), RANKS, public_tokenizers.PATTERN).collect() == []
