"""Language identification: held-out accuracy and defined results for odd texts."""

import collections
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import language_id
from ledgerloom.llm.registry import QUERIES
from tests.llm.frames import documents, empty, odd_rows


def test_held_out_accuracy(spark, small):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op4_language"](spark, small).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and len(held) > 30
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got) <= 0.02 * len(got)
    again = QUERIES["op4_language"](spark, small).collect()
    assert sorted(got) == sorted(again)


def test_odd_texts(spark):
    rows = [(i, f"alpha beta gamma {i} " * 4, "en") for i in range(20)]
    rows += [(100 + i, f"ωμέγα δέλτα {i} " * 4, "el") for i in range(20)] + [(300, "abc", None)]
    docs = documents(spark, rows, clashes=True)
    model = language_id.train(docs, F.lit(True))
    assert model.languages == ["el", "en"]
    got = language_id.predict(documents(spark, odd_rows(), clashes=True), model).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.language.lang_pred == "und") == (not letters)
        assert r.language.rejected or letters
    greek = language_id.predict(documents(spark, [(1, "δέλτα ωμέγα"), (2, "gamma beta")]), model)
    assert {r.doc_id: r.language.lang_pred for r in greek.collect()} == {1: "el", 2: "en"}


def _texts(rand, letters, rows, words=60):
    """Texts of words made of a few dozen syllables of one alphabet."""
    syllables = ["".join(rand.sample(letters, rand.randint(2, 3))) for _ in range(40)]
    word = lambda: "".join(rand.choices(syllables, k=rand.randint(1, 4)))
    return [" ".join(word() for _ in range(words)) for _ in range(rows)]


def test_junk_and_an_unlearned_language_are_rejected(spark):
    rand = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    known = [(text, lang) for lang in ("aa", "bb", "cc") for text in _texts(rand, letters, 160)]
    rand.shuffle(known)
    rows = [(i, text, lang) for i, (text, lang) in enumerate(known)]
    model = language_id.train(documents(spark, rows[:360]), F.lit(True))
    fresh = [language_id.classify(text, model) for _, text, _ in rows[360:]]
    assert [found[0] for found in fresh] == [lang for _, _, lang in rows[360:]]
    assert sum(rejected for _, _, rejected in fresh) <= 0.02 * len(fresh)
    junk = [" ".join("".join(rand.choices(letters, k=7)) for _ in range(60)) for _ in range(40)]
    unlearned = _texts(rand, letters, 40)
    assert all(language_id.classify(text, model)[2] for text in junk + unlearned)


def test_every_label_is_learned_from_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(language_id, "ROWS_PER_LANGUAGE", 5)
    rows = [(i, f"alpha beta {i}", f"l{i % 250:03d}") for i in range(500)]
    rows += [(1000 + i, f"gamma delta {i}", "hot") for i in range(400)]
    rows += [(7, "one row that comes up again and again", "hot")] * 400
    docs = documents(spark, rows)
    drawn = language_id.training_sample(docs, "text", "lang", F.col("doc_id"))
    sizes = collections.Counter(row[0] for row in drawn)
    assert len(sizes) == 251 and sizes["hot"] == 5
    assert all(size == 2 for name, size in sizes.items() if name != "hot")


def test_training_texts_keep_all_buckets():
    text = " ".join(map(chr, range(0x4E00, 0x4E00 + 9000)))
    buckets, counts = language_id._features(text)
    assert counts.sum() == sum(map(len, language_id.gram_buckets(text)))
    assert len(buckets) > 4096


def test_without_labels(spark):
    model = language_id.train(empty(spark), F.lit(True))
    assert language_id.classify("words", model) == ("und", 0.0, True)
    assert language_id.predict(empty(spark), model).collect() == []


def test_grams_stay_inside_words():
    grams = lambda text: np.concatenate(list(language_id.gram_buckets(text)))
    assert sorted(grams("ab cd")) == sorted(grams("cd, AB!"))
    assert len(grams("ab")) == 3 + 2 + 1


def test_long_texts_go_piece_by_piece(monkeypatch):
    text = "alpha Beta, gamma " * 50
    whole = np.sort(np.concatenate(list(language_id.gram_buckets(text))))
    monkeypatch.setattr(language_id, "PIECE_LETTERS", 7)
    assert np.array_equal(whole, np.sort(np.concatenate(list(language_id.gram_buckets(text)))))
