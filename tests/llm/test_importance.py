"""Importance resampling against a plain reading of the rule, text by text."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import importance
from ledgerloom.llm.registry import QUERIES
from tests.llm.frames import documents, empty, odd_rows

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def features(text):
    folded = (text or "").translate(str.maketrans(UPPER, UPPER.lower()))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10000 for run in runs]


def by_rule(rows, target):
    """Sorted (doc_id, n_words, n_features, weight, score, rank); ranks by score and id."""
    read = [(doc_id, *features(text)) for doc_id, text in rows]
    s, t = Counter(), Counter()
    for _, _, buckets in read:
        s.update(buckets)
    for text in target:
        t.update(features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10000.0) / ((s[b] + 1.0) * (all_t + 10000.0))))
        for b in range(10000)
    }
    scored = []
    for doc_id, n, buckets in read:
        weight = sum(map(gain.__getitem__, buckets))
        name = "42:" + ("" if doc_id is None else str(doc_id))
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        scored.append([doc_id, n, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = [row for row in scored if row[1] >= 20]
    able.sort(key=lambda row: (-row[4], row[0] is None, row[0] or 0))
    ranks = {id(row): i + 1 for i, row in enumerate(able[: len(able) * 5 // 100])}
    return in_order((*row, ranks.get(id(row))) for row in scored)


def in_order(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: tuple(map(str, row)))


def prose(rng, words, vocabulary=300):
    return " ".join(rng.choice(["", "É", "x", "Ab"]) + f"w{int(rng.expovariate(0.02)) % vocabulary}" for _ in range(words))


def rows_of(seed=3, n=400):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(0, 60))) for i in range(n)]
    rows += [(1000 + i, "the same words again " * 6) for i in range(40)]  # ties but for the noise
    rows += [(7, rows[7][1]), (None, rows[9][1] + " " + rows[8][1])] + odd_rows()
    return rows


TARGET = ["w1 w2 w3 w4 w5 the same words", None, "", "Éw7 Abw3 w2"]


@pytest.mark.parametrize("clashes", [False, True])
def test_same_as_rule(spark, clashes):
    rows = rows_of()
    target = spark.createDataFrame([(str(i), t) for i, t in enumerate(TARGET)], "item_id string, text string")
    drawn = importance.resample(documents(spark, rows, clashes), target)
    assert drawn.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert in_order(drawn.collect()) == by_rule(rows, TARGET)


def test_registered_query_same_as_rule(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{small}/benchmark.parquet").select("text").collect()]
    want = in_order((i, f, w, s, r) for i, _, f, w, s, r in by_rule(rows, target))
    assert in_order(QUERIES["op11_importance_resampling"](spark, small).collect()) == want


def test_ties_go_to_the_smaller_id(spark):
    # One text and one draw per id: rows with one id tie, and of different ids the noise decides.
    rows = [(5, "a b c d e " * 5)] * 30 + [(6, "a b c d e " * 5)] * 30
    target = spark.createDataFrame([("x", "a b")], "item_id string, text string")
    found = importance.resample(documents(spark, rows), target).collect()
    drawn = [r for r in found if r["rank"] is not None]
    assert sorted(r["rank"] for r in drawn) == [1, 2, 3] and len(found) == 60
    assert {r["doc_id"] for r in drawn} == {max(found, key=lambda r: (r["score"], -r["doc_id"]))["doc_id"]}


def test_table_slots():
    rng = random.Random(1)
    text = prose(rng, 4000, 50) + " " + "longword" * 9 + " " + "y" * 31 + " " + "y" * 32
    words = importance.Words([text.encode(), b"", b"w1 w2", "w1 é".encode()])
    start, length, owner = words.runs()
    table = importance.FeatureTable(words, start, length)
    raw = words.buffer.tobytes()
    spell = {}
    for slot, s, n in zip(table.slots.tolist(), start[table.order].tolist(), length[table.order].tolist()):
        spell.setdefault(slot, set()).add(raw[s : s + n])
    assert all(len(x) == 1 for x in spell.values())  # one feature a slot
    assert len({x for some in spell.values() for x in some}) == len(spell)  # and one slot a feature
    counted = Counter(raw[s : s + n] for s, n in zip(start.tolist(), length.tolist()))
    for slot, (feature,) in ((k, tuple(v)) for k, v in spell.items()):
        assert table.bucket[slot] == zlib.crc32(feature) % 10000 and table.count[slot] == counted[feature]
    assert owner.max() == 3 and 1 not in owner


def test_equal_keys_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(importance, "short_hashes", lambda views, start, length: np.full(len(start), 9, np.uint64))
    texts = [prose(random.Random(2), 120, 30).encode()]
    want = Counter(features(texts[0].decode())[1])
    totals = importance.bucket_totals(texts)
    assert {b: int(n) for b, n in enumerate(totals) if n} == dict(want)


@pytest.mark.parametrize("length", range(1, 32))
def test_hashes_and_checksums(length):
    data = np.frombuffer(random.Random(length).randbytes(300), np.uint8)
    views, start = importance.Views(data), np.arange(0, 256)
    pieces = [data[s : s + length].tobytes() for s in start]
    assert importance.short_hashes(views, start, length).tolist() == [xxhash.xxh64_intdigest(p) for p in pieces]
    assert importance.short_crcs(views, start, length).tolist() == [zlib.crc32(p) for p in pieces]


@pytest.mark.parametrize("chunk", [1, 7, 64, 1000])
def test_pieces_make_no_difference(chunk):
    texts = [t and t.encode() for _, t in rows_of(5, 40)] + [b"", None, b"one two", "ö".encode() * 70]
    gains = np.arange(importance.BUCKETS) * 7 % 1000 - 500
    assert (importance.bucket_totals(texts, chunk) == importance.bucket_totals(texts)).all()
    for cut, whole in zip(importance.text_weights(texts, gains, chunk), importance.text_weights(texts, gains)):
        assert cut.tolist() == whole.tolist()


def test_very_long_texts():
    rng = random.Random(4)
    texts = [(prose(rng, 1000) + " ").encode() * 1500, "日本語".encode() * 400_000, b"z" * 3_000_000]
    started = time.time()
    words, found, _ = importance.text_weights(texts, np.ones(importance.BUCKETS, np.int64))
    assert words.tolist() == [1_500_000, 1, 1] and found.tolist() == [4_499_997, 1, 1]
    assert time.time() - started < 60


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id string, text string")
    assert importance.resample(empty(spark), none).collect() == []
    rows = rows_of(6, 50)
    assert in_order(importance.resample(documents(spark, rows), none).collect()) == by_rule(rows, [])


def test_no_counts_from_other_columns(spark):
    rows = rows_of(8, 30)
    docs = documents(spark, rows).withColumn("source", F.lit(None).cast("string"))
    target = spark.createDataFrame([(None, t) for t in TARGET], "item_id string, text string")
    assert in_order(importance.resample(docs, target).collect()) == by_rule(rows, TARGET)
