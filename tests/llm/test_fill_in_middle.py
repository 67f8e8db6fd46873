"""Fill-in-the-middle against plain slicing of the texts."""

import hashlib
import time

import pytest
import regex
from pyspark.sql import functions as F

from ledgerloom.llm import fill_in_middle
from tests.llm.frames import documents, empty, odd_rows


def plain_cut(doc_id, text, units=None, seed=1):
    """(n, form, prefix_chars, middle_chars, output) by slices."""
    text = text or ""
    units = list(text) if units is None else units
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or h3 % 100 >= 90 or "<P>" in text or "<S>" in text or "<M>" in text:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def in_order(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: tuple(map(str, row)))


def outcome(spark, rows, clashes=False, **options):
    cut = fill_in_middle.transform(documents(spark, rows, clashes), **options)
    rebuilt = fill_in_middle.restored(F.col("output"), F.col("form"))
    found = cut.withColumn("back", rebuilt).collect()
    assert cut.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    return in_order(found)


MARKED = [
    (100, "a <P> b"), (101, "<S>"), (102, "x<M>y"), (103, "<P"), (104, "<"), (105, "S><P><"),
    (106, "a\r\nb c\x00d"), (107, "é\U0001f600‍\U0001f600"), (108, "<<>><P <S <M"),
]
MANY = [(1000 + i, "<é\n😀" * (i % 7) + "x" * (i % 5)) for i in range(300)]


@pytest.mark.parametrize("clashes", [False, True])
def test_same_as_slices(spark, clashes):
    rows = odd_rows() + MARKED + MANY
    found = outcome(spark, rows, clashes)
    want = in_order((i, *plain_cut(i, text), text or "") for i, text in rows)
    assert found == want
    assert {row[2] for row in found} == set(fill_in_middle.FORMS)


def test_stretches_make_no_difference(spark):
    rows = odd_rows() + MANY[:50]
    assert outcome(spark, rows, match_units=3) == outcome(spark, rows)


def test_words_as_units(spark):
    unit = r"\S+\s*|\s+"
    texts = ["one two  three\nfour ", "", None, " lead", "solo", "a b c d e f g h i j k l m"]
    rows = [(i, texts[i % len(texts)]) for i in range(60)]
    found = outcome(spark, rows, unit=unit, seed=5)
    units = lambda text: regex.findall(unit, text or "")
    want = in_order((i, *plain_cut(i, t, units(t), 5), t or "") for i, t in rows)
    assert found == want


def test_a_unit_is_not_matched_otherwise_to_fit():
    # "ab" takes both letters wherever it can; what no unit matches is one last unit.
    assert fill_in_middle.Cutter("ab|a").ends("aabab").tolist() == [1, 3, 5]
    assert fill_in_middle.Cutter("ab|a").ends("abbab").tolist() == [2, 5]
    assert fill_in_middle.Cutter("ab|a", 2).ends("abaabac").tolist() == [2, 3, 5, 6, 7]
    with pytest.raises(ValueError):
        fill_in_middle.Cutter("x*")


def test_other_marks_that_could_form_across_a_border(spark):
    marks = ("aa", "bb", "cc")
    for first in range(4):
        digest = f"{first:08x}{first:08x}" + "0" * 7 + "0" + "00000063"
        row = fill_in_middle.rearranged("aba", digest, fill_in_middle.Cutter(), marks)
        if row["form"] == "plain":
            assert row["output"] == "aba" and row["prefix_chars"] is None
        else:
            assert all(row["output"].count(mark) == 1 for mark in marks)


def test_shares(spark):
    rows = [(i, "some text to cut") for i in range(4000)]
    found = outcome(spark, rows)
    share = {form: sum(r[2] == form for r in found) / 4000 for form in fill_in_middle.FORMS}
    assert abs(share["plain"] - 0.1) < 0.02 and abs(share["spm"] - 0.18) < 0.02


def test_very_long_text(spark):
    text = "wört \U0001f600\n" * 500_000
    started = time.time()
    found = outcome(spark, [(3, text), (4, "short")])
    assert found == in_order([(3, *plain_cut(3, text), text), (4, *plain_cut(4, "short"), "short")])
    assert time.time() - started < 60


def test_empty_table(spark):
    assert fill_in_middle.transform(empty(spark)).collect() == []
