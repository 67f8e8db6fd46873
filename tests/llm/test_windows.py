"""Substring deduplication on words and on bytes, against brute force."""

import random
import tracemalloc

import numpy as np
import pytest

from ledgerloom.llm import repeats, suffix_sort, word_windows
from tests.llm.frames import documents, empty, odd_rows


def removed(sequences, window):
    """(id, text) -> covered places; rows with one id and text count once."""
    seen, covered = set(), {}
    order = sorted(
        sequences.items(),
        key=lambda item: (item[0][0] is not None, item[0][0] or 0, tag(item[0][1])),
    )
    for row, units in order:
        own = covered.setdefault(row, set())
        for i in range(len(units) - window + 1):
            piece = tuple(units[i : i + window])
            if piece in seen:
                own.update(range(i, i + window))
            seen.add(piece)
    return covered


def tag(text):
    import xxhash

    return 0 if text is None else xxhash.xxh64_intdigest(text.encode())


def places(spans):
    assert all(a.end < b.start for a, b in zip(spans, spans[1:]))
    return {i for span in spans for i in range(span.start, span.end)}


def some_rows(seed, alphabet, sizes):
    random.seed(seed)
    passages = [[random.choice(alphabet) for _ in range(random.randint(3, 40))] for _ in range(6)]
    rows = []
    for i in range(40):
        units = []
        while len(units) < random.choice(sizes):
            units += random.choice(passages) if random.random() < 0.4 else [random.choice(alphabet)]
        rows.append((random.randint(-5, 60) if i % 9 else 7, units))
    return rows


@pytest.mark.parametrize("seed,window,gram", [(1, 5, 2), (2, 20, 4), (3, 3, 3), (4, 9, 1)])
def test_words(spark, seed, window, gram):
    letters = ["a", "b", "the", "Ärger", "x\x1cy", "z" * 30]
    rows = [
        (i, random.choice([" ", "\n", " \t "]).join(units)) for i, units in some_rows(seed, letters, (1, 30, 90))
    ] + odd_rows()
    df = word_windows.remove_repeated_words(
        documents(spark, rows, clashes=True), window=window, gram=gram
    )
    words = {row: (row[1] or "").encode().split() for row in rows}
    want = removed(words, window)
    got = df.collect()
    assert len(got) == len(rows)
    left = list(rows)
    for r in got:
        # The kept text and spans name the row; repeated ids are told apart by their results.
        row = next(
            x for x in left
            if x[0] == r.doc_id and len(words[x]) == r.n_words and places(r.spans) == want[x]
            and r.kept_text.encode()
            == b" ".join(w for i, w in enumerate(words[x]) if i not in want[x])
        )
        left.remove(row)
    assert not left


@pytest.mark.parametrize("seed,window,gram", [(1, 10, 3), (2, 100, 24), (3, 5, 2)])
def test_bytes(spark, seed, window, gram):
    alphabet = ["a", "b", "é", "\U0001f600", "lorem ipsum dolor sit amet "]
    rows = [(i, "".join(units)) for i, units in some_rows(seed, alphabet, (1, 30, 120))] + odd_rows()
    df = suffix_sort.remove_repeated_bytes(documents(spark, rows), window=window, gram=gram)
    data = {row: (row[1] or "").encode() for row in rows}
    want = removed(data, window)
    got, left = df.collect(), list(rows)
    assert len(got) == len(rows)
    for r in got:
        row = next(
            x for x in left
            if x[0] == r.doc_id and len(data[x]) == r.n_bytes and places(r.spans) == want[x]
            and bytes(r.kept) == bytes(b for i, b in enumerate(data[x]) if i not in want[x])
        )
        left.remove(row)
    assert not left


@pytest.mark.parametrize("hashes", ["true", "one value", "few values"])
def test_suffix_sort_survives_collisions(monkeypatch, hashes):
    if hashes != "true":
        keep = np.uint64(0 if hashes == "one value" else 3)
        monkeypatch.setattr(
            suffix_sort, "range_hashes", lambda *a: repeats.range_hashes(*a) & keep
        )
    random.seed(9)
    for window in (4, 8, 13):
        text = bytes(random.choice(b"ab") for _ in range(400))
        starts = np.arange(len(text) - window + 1)
        cell = np.sort(np.random.default_rng(1).integers(0, 3, len(starts)))
        sorter = suffix_sort.SuffixSorter(text, window)
        got = sorter.repeated(starts, cell)
        seen, want = set(), []
        for s, c in zip(starts.tolist(), cell.tolist()):
            want.append((c, text[s : s + window]) in seen)
            seen.add((c, text[s : s + window]))
        assert got.tolist() == want
        if hashes == "true":
            order = sorter.merge_sort(starts, cell)
            assert order.tolist() == sorted(
                range(len(starts)), key=lambda i: (cell[i], text[starts[i] : starts[i] + window], i)
            )


def hot_stretches(n, window, alphabet, before):
    """Stretches around two minimisers, nine of ten around the first one."""
    texts, windows, place = [], [], []
    for _ in range(n):
        place.append(random.randint(0, before))
        windows.append(random.randint(1, min(place[-1] + 1, window - 1)))
        body = "".join(random.choices(alphabet, k=place[-1])) + "G" + "".join(random.choices(alphabet, k=window))
        texts.append((body + "x" * window * 2)[: windows[-1] + window - 1].encode())
    return texts, np.array(windows), np.array(place), np.arange(n) % 10 // 9


@pytest.mark.parametrize("limit", [1, 60, 400, 3000, 1 << 20])
@pytest.mark.parametrize("window", [4, 8, 13, 20])
@pytest.mark.parametrize("alphabet", ["ab\0", "abcdefgh", "a"])
def test_suffixes_in_batches(monkeypatch, limit, window, alphabet):
    random.seed(window)
    monkeypatch.setattr(suffix_sort, "BATCH_BYTES", limit)
    texts, windows, place, group = hot_stretches(200, window, alphabet, window - 1)
    seen, want = set(), []
    for text, n, at, g in zip(texts, windows.tolist(), place.tolist(), group.tolist()):
        for i in range(n):
            want.append((g, at - i, text[i : i + window]) in seen)
            seen.add((g, at - i, text[i : i + window]))
    sorted_ = []

    class Noted(suffix_sort.SuffixSorter):
        def __init__(self, text, window):
            sorted_.append(len(text))
            super().__init__(text, window)

    monkeypatch.setattr(suffix_sort, "SuffixSorter", Noted)
    got = suffix_sort.suffix_repeats(texts, windows, place, group, window)
    assert got.tolist() == want
    assert max(sorted_, default=0) <= max(limit, window)


def test_memory_of_a_hot_minimiser():
    """A line of many documents fills a bucket; the sort takes its windows in batches."""
    random.seed(5)
    texts, windows, place, group = hot_stretches(20_000, 100, "abcdefgh", 76)
    suffix_sort.suffix_repeats(texts[:10], windows[:10], place[:10], group[:10], 100)
    tracemalloc.start()
    got = suffix_sort.suffix_repeats(texts, windows, place, group, 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == windows.sum()
    assert peak < 60e6


def test_pieces_of_long_documents_hold_every_window(monkeypatch):
    import pyarrow as pa

    random.seed(12)
    monkeypatch.setattr(suffix_sort, "PIECE_BYTES", 16)
    monkeypatch.setattr(word_windows, "PIECE_WORDS", 7)
    letters = [random.choice("ab ") for _ in range(300)]
    texts = pa.array(["".join(letters), "a b c", None])
    none = np.zeros(1 << repeats.SLOT_BITS, bool)
    for units, whole in ((suffix_sort.byte_units(9, 3), texts[0].as_py().encode()),
                         (word_windows.word_units(5, 2), texts[0].as_py().encode().split())):
        found = {}
        for block in units.blocks(texts):
            s = repeats.stretches(block, units, none)
            for low, high, row, start, n in zip(s.low, s.high, s.row, s.start, s.windows):
                assert row == 0
                piece = block.data[low:high]
                piece = piece if isinstance(whole, bytes) else piece.split(b" ")
                for i in range(n):
                    assert start + i not in found
                    found[start + i] = piece[i : i + units.window]
        want = {i: whole[i : i + units.window] for i in range(len(whole) - units.window + 1)}
        assert found == want


def test_common_grams_rank_last(spark):
    """A line in every document is common; windows around it get other minimisers."""
    line = " ".join(f"w{i}" for i in range(8))
    random.seed(2)
    rows = [
        (i, f"{random.getrandbits(60)} {random.getrandbits(60)} {line} {random.getrandbits(60)}")
        for i in range(300)
    ]
    units = word_windows.word_units(6, 3)
    bits = repeats.common_slots(documents(spark, rows), "text", units, 4)
    assert 1 <= np.unpackbits(bits).sum() <= 2 * 4 / repeats.SHARE_OF_GROUP
    got = word_windows.remove_repeated_words(documents(spark, rows), window=6, gram=3).collect()
    assert sum(bool(r.spans) for r in got) == 299


def test_empty(spark):
    assert word_windows.remove_repeated_words(empty(spark)).collect() == []
    assert suffix_sort.remove_repeated_bytes(empty(spark)).collect() == []


def test_sliding_least():
    values = np.random.default_rng(3).integers(0, 100, 50)
    for width in range(1, 20):
        want = [values[i : i + width].min() for i in range(50 - width + 1)]
        assert repeats.sliding_least(values, width).tolist() == want
