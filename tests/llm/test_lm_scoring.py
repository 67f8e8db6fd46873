"""Language-model scoring: base scores against brute force, the filter against true counts."""

import collections
import inspect
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import lm_scoring
from tests.llm.frames import documents, empty, odd_rows


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def test_base_scores(spark):
    random.seed(3)
    words = [f"w{i}" for i in range(30)]
    rows = odd_rows() + [(i, " ".join(random.choices(words, k=i % 40))) for i in range(100, 160)]
    got = lm_scoring.score(documents(spark, rows, clashes=True), F.col("doc_id") % 3 != 0).collect()
    counts = collections.Counter()
    for doc, text in rows:
        if doc is not None and math.fmod(doc, 3):
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    want = collections.Counter()
    for doc, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        want[(doc, len(own), sum(counts[t] > 0 for t in own), total, round(base, 6))] += 1
    assert want == collections.Counter(
        (r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
    )
    assert all(r.score <= 0 for r in got)


def test_seen_order_scores_above_shuffled(spark):
    random.seed(4)
    words = [f"w{i}" for i in range(200)]
    line = words * 3
    mixed = random.sample(line, len(line))
    rows = [(1, " ".join(line)), (2, " ".join(line)), (30, " ".join(line)), (31, " ".join(mixed))]
    got = {r.doc_id: r for r in lm_scoring.score(documents(spark, rows), F.col("doc_id") < 10).collect()}
    assert abs(got[30].base_score - got[31].base_score) < 1e-6
    assert got[30].score > got[31].score + 50


def test_filter_gives_levels_back():
    random_ = np.random.default_rng(1)
    keys = np.unique(random_.integers(0, 2**40, 20_000).astype(np.uint64))
    counts = np.maximum(random_.zipf(1.5, len(keys)) % 100_000, 1)
    bits = lm_scoring.filter_slice(keys, counts, 1 << 20)
    one = lm_scoring.PairFilter(bits, np.array([0]), np.array([len(bits) * 8], np.uint64))
    found = one.levels(np.zeros(len(keys), int), keys)
    true = lm_scoring.level_of(counts)
    assert (found >= true).all() and (found == true).mean() > 0.9
    other = random_.integers(2**41, 2**42, 20_000).astype(np.uint64)
    assert (one.levels(np.zeros(len(other), int), other) > 0).mean() < 0.08


def test_full_filter_holds_the_most_frequent():
    keys = np.arange(1, 5001, dtype=np.uint64)
    counts = np.where(keys <= 500, 64, 1)
    bits = lm_scoring.filter_slice(keys, counts, 5000)
    assert len(bits) <= 5000
    one = lm_scoring.PairFilter(bits, np.array([0]), np.array([len(bits) * 8], np.uint64))
    found = one.levels(np.zeros(len(keys), int), keys)
    assert (found[:500] >= 7).all() and (found[500:] == 0).mean() > 0.9
    assert lm_scoring.level_of(np.array([0, 1, 2, 3, 4, 1023, 1024])).tolist() == [0, 1, 2, 2, 3, 10, 11]


def test_pairs_seen_once_count_at_any_size(spark):
    random.seed(6)
    line = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(line)), (30, " ".join(line)), (31, " ".join(random.sample(line, len(line))))]
    # Where scoring takes a bound on the filter, a bound that the pairs exceed.
    bound = {"filter_bytes": 64} if "filter_bytes" in inspect.signature(lm_scoring.score).parameters else {}
    got = {r.doc_id: r for r in lm_scoring.score(documents(spark, rows), F.col("doc_id") < 10, **bound).collect()}
    assert abs(got[30].base_score - got[31].base_score) < 1e-6
    assert got[30].score > got[31].score + 500


def test_nothing_to_learn(spark):
    assert lm_scoring.score(empty(spark), F.lit(True)).collect() == []
    got = lm_scoring.score(documents(spark, [(1, "a b")]), F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)]
