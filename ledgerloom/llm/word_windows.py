"""Exact substring deduplication on words: super-k-mers, and buckets that sort windows.

Consecutive windows that share a minimiser travel as one packed string to its bucket
(see ``repeats``); there the windows themselves are sorted, so equal ones are counted
exactly, without any hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from ledgerloom.llm.packing import mixed
from ledgerloom.llm.repeats import Block, Units, find_repeats, prefix_hashes, range_hashes

WINDOW_WORDS = 20
GRAM_WORDS = 4
_SPACE, _LINE = 32, 10
# First windows of a piece of a long document.
PIECE_WORDS = 100_000


def _word_block(texts: list[bytes], rows: list[int], before: list[int]) -> Block:
    """Documents with single spaces between words, one per line (no word holds either)."""
    data = b"\n".join(texts) + b"\n"
    letters = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero((letters == _SPACE) | (letters == _LINE))
    starts = np.concatenate([[0], ends[:-1] + 1])
    prefix = prefix_hashes(letters.astype(np.uint64) + np.uint64(1))
    hashes = mixed(range_hashes(prefix, starts, ends - starts))
    first = np.concatenate([[0], np.flatnonzero(letters[ends] == _LINE) + 1])
    return Block(data, starts, ends, hashes, first, np.array(rows), np.array(before))


def word_units(window: int, gram: int) -> Units:
    def pieces(raw: bytes) -> list[tuple[int, bytes]]:
        words = raw.split()  # bytes split at ASCII white space only
        return [
            (i, b" ".join(words[i : i + PIECE_WORDS + window - 1]))
            for i in range(0, len(words) - window + 1, PIECE_WORDS)
        ]

    return Units(window, gram, pieces, _word_block)


def sorted_repeats(texts: list[bytes], windows: np.ndarray, window: int) -> np.ndarray:
    """For each window of each stretch: whether an equal one comes before it."""
    cut: list[bytes] = []
    for text, count in zip(texts, windows.tolist()):
        words = text.split(b" ")
        cut += [b" ".join(words[i : i + window]) for i in range(count)]
    order = sorted(range(len(cut)), key=cut.__getitem__)  # stable: equal ones stay in order
    repeated = np.zeros(len(cut), bool)
    for before, after in zip(order, order[1:]):
        repeated[after] = cut[before] == cut[after]
    return repeated


def remove_repeated_words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    window: int = WINDOW_WORDS, gram: int = GRAM_WORDS, groups: int | None = None,
) -> DataFrame:
    """One row per document row: id, ``n_words``, ``spans``, ``kept_text``.

    ``spans`` are the maximal ranges of words covered by windows whose words also start
    earlier: in a document with a smaller id, or earlier in the same document.  What is
    kept is joined by single spaces.  Null and empty texts have no words and keep ''.
    """
    def repeats(texts, windows, place, group):
        return sorted_repeats(texts, windows, window)

    def finish(text: str | None, spans: np.ndarray) -> tuple:
        words = (text or "").encode().split()
        kept, at = [], 0
        for start, end in spans.tolist():
            kept += words[at:start]
            at = end
        ranges = [{"start": start, "end": end} for start, end in spans.tolist()]
        return len(words), ranges, b" ".join(kept + words[at:]).decode()

    return find_repeats(
        docs, id_column, text_column, word_units(window, gram), repeats, finish,
        "n_words bigint, spans array<struct<start:bigint,end:bigint>>, kept_text string", groups,
    )
