"""Quality rules: counts against brute force, thresholds against exact quantiles."""

import collections
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import quality_rules
from tests.llm.frames import documents, empty, odd_rows


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)
    )


def test_counts(spark):
    random.seed(6)
    rows = odd_rows() + [
        (100 + i, random.choice([" ", "\n", " # "]).join(random.choices("a b cc ü$ |".split(), k=i)))
        for i in range(60)
    ]
    got = quality_rules.judge(documents(spark, rows, clashes=True)).collect()
    want = sorted(str((doc, *plain(text))) for doc, text in rows)
    assert want == sorted(
        str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
        for r in got
    )
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def plain_text(rand, words=100, lines=10, hashes=0, times=0, letters=5):
    """A text of random words: ``hashes`` of them with a symbol, its first line ``times`` more."""
    made = ["".join(rand.choices("abcdefghijklmnop", k=max(1, letters + rand.randint(-1, 1)))) for _ in range(words)]
    for i in range(hashes):
        made[i] += "#"
    cut = words // lines
    rows = [" ".join(made[i : i + cut]) for i in range(0, words, cut)]
    return "\n".join(rows[: lines - times] + rows[:1] * times)


# Feature and side -> (group of plain texts, text to reject): all of them pass the base rule.
PLANTED = {
    "word_length below": ("word_length", {}, {"letters": 2}),
    "word_length above": ("word_length", {}, {"letters": 12}),
    "symbol_share above": ("symbol_share", {}, {"hashes": 10}),
    "symbol_share above, in a group with symbols": ("symbol_share", {"hashes": 10}, {"hashes": 60}),
    "symbol_share below": ("symbol_share", {"hashes": 50}, {}),
    "dup_line_share above": ("dup_line_share", {"lines": 50}, {"lines": 50, "times": 8}),
    "dup_line_share below": ("dup_line_share", {"lines": 50, "times": 8}, {"lines": 50}),
    "repeat_share above": ("repeat_share", {"words": 200, "lines": 25}, {"words": 200, "lines": 25, "times": 3}),
    "repeat_share below": ("repeat_share", {"words": 200, "lines": 25, "times": 3}, {"words": 200, "lines": 25}),
}


def test_planted_outliers_of_every_feature_and_side_go_and_the_rest_stays(spark):
    rand = random.Random(7)
    rows = []
    for number, (_, usual, odd) in enumerate(PLANTED.values()):
        group = [plain_text(rand, **usual) for _ in range(250)] + [plain_text(rand, **odd)]
        rows += [(1000 * number + i, text, f"g{number}") for i, text in enumerate(group)]
    docs = documents(spark, rows).withColumn("source", F.lit("one"))
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    for number, (feature, _, _) in enumerate(PLANTED.values()):
        odd = got[1000 * number + 250]
        assert not odd.base_failed and feature in odd.outliers and not odd.kept, (number, odd)
    usual = [r.kept for r in got.values() if r.doc_id % 1000 < 250]
    assert sum(usual) >= 0.98 * len(usual)


def test_one_unit_never_decides(spark):
    rand = random.Random(8)
    rows = [(i, plain_text(rand)) for i in range(250)]
    rows += [(900, plain_text(rand, hashes=1)), (901, plain_text(rand, lines=50, times=1))]
    docs = documents(spark, rows).withColumn("source", F.lit("one"))
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert got[900].n_symbols == 1 and got[900].kept
    assert got[901].n_dup_lines == 1 and got[901].kept


def test_small_groups_borrow_from_their_length_class(spark):
    rand = random.Random(9)
    rows = [(i, plain_text(rand), "en") for i in range(250)]
    rows += [(500 + i, plain_text(rand, words=2000, letters=9), "en") for i in range(250)]
    rows += [(900, plain_text(rand), "xx"), (901, plain_text(rand, letters=9), "xx"),
             (902, plain_text(rand, words=2000, letters=9), "xx")]
    got = {r.doc_id: r for r in quality_rules.judge(documents(spark, rows)).collect()}
    assert got[900].kept and got[902].kept
    assert got[901].outliers == ["word_length"]


def test_labelled_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    good = [r for r in quality_rules.judge(docs).collect() if quality.get(r.doc_id) == 1 and not r.base_failed]
    assert len(good) > 20 and sum(r.kept for r in good) >= 0.95 * len(good)


def test_sketches_merge_and_bound_the_error(spark):
    random.seed(8)
    values = [random.lognormvariate(0, 2) for _ in range(3000)] + [0.0] * 10
    frame = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "v double, part int")
    sketch = (
        frame.select("part", F.lit("f").alias("feature"), quality_rules.bucket_of(F.col("v")).alias("bucket"))
        .groupBy("part", "feature", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    )
    row = quality_rules.quantiles(quality_rules.merged(sketch, []), []).first()
    ordered = np.sort(values)
    true = [ordered[math.ceil(q * len(ordered)) - 1] for q in (quality_rules.LOW, quality_rules.MIDDLE, quality_rules.HIGH)]
    width = 1.02 * 2 * quality_rules.RELATIVE_ERROR
    assert true[0] * (1 - width) <= row.low <= true[0]
    assert abs(row.middle - true[1]) <= width / 2 * true[1]
    assert true[2] <= row.high <= true[2] * (1 + width)
    assert row.rows == len(values)


def test_null_language_and_source(spark):
    rows = [(i, "some words that make a line of text for the rule set", None) for i in range(5)]
    got = quality_rules.judge(documents(spark, rows).withColumn("source", F.lit(None).cast("string")))
    assert [r.kept for r in got.collect()] == [True] * 5
    assert quality_rules.judge(empty(spark)).collect() == []
