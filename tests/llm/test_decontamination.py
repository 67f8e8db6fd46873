"""Benchmark decontamination against brute force."""

import random
import re

import pytest

from ledgerloom.llm import decontamination
from tests.llm.frames import documents, empty, odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(doc, items, window):
    own, hit, found = words(doc), set(), set()
    for item, text in items:
        parts = words(text)
        n = min(window, len(parts))
        grams = {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i : i + n]) in grams:
                hit.update(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    return len(own), len(hit), sorted(found), bool(hit)


@pytest.mark.parametrize("limit", [0, 500_000])
@pytest.mark.parametrize("seed,window,gram", [(1, 10, 5), (2, 4, 2), (3, 3, 3)])
def test_like_brute_force(spark, seed, window, gram, limit):
    random.seed(seed)
    vocabulary = ["a", "B", "c1", "Über", "é", "the", "of"]
    item = lambda: " ".join(random.choices(vocabulary, k=random.randint(1, 25)))
    items = [(i, item()) for i in range(12)] + [(3, item()), (None, item()), (40, None), (41, "?!")]
    items += [(0, items[0][1])]
    rows = odd_rows()
    for i in range(40):
        text = item()
        if i % 2:
            source = (random.choice(items)[1] or "").split()
            text += ", " + "-".join(source[random.randrange(3) :]) + "; " + item()
        rows.append((100 + i, text))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.find_leaks(
        documents(spark, rows, clashes=True), benchmark, window=window, gram=gram, broadcast_rows=limit
    ).collect()
    want = sorted(str((doc, *plain(text, items, window))) for doc, text in rows)
    assert sorted(
        str((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated)) for r in got
    ) == want


def test_rows_that_share_an_id_are_judged_apart(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(1, passage), (1, "x " * 30), (1, "y " + passage)]
    benchmark = spark.createDataFrame([(5, passage)], "item_id bigint, text string")
    got = decontamination.find_leaks(documents(spark, rows), benchmark).collect()
    assert sorted((r.n_words, r.n_hit) for r in got) == [(12, 12), (13, 12), (30, 0)]


def test_empty(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert decontamination.find_leaks(empty(spark), some).collect() == []
    got = decontamination.find_leaks(documents(spark, [(1, "a b c")]), none).collect()
    assert [(r.n_words, r.n_hit, r["items"], r.contaminated) for r in got] == [(3, 0, [], False)]


def test_no_python_on_the_path(spark):
    some = spark.createDataFrame([(1, "a b c " * 9)], "item_id bigint, text string")
    found = decontamination.find_leaks(documents(spark, [(1, "a b c " * 9)]), some)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
