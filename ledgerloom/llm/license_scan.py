"""License notices in texts: winnowed fingerprints pick candidates, alignment confirms them.

Templates are indexed by the hashes of all their word pairs.  A text keeps the smaller
hash of every two neighbouring pairs, so three words in a row shared with a template
always leave a hit.  Hits of one template that lie close to one diagonal make a candidate
if they are a fair part of what the whole template would leave; a banded alignment of the
template with that part of the text then gives the share of its words that match.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.packing import mixed
from ledgerloom.llm.repeats import (
    Block, Units, gram_hashes, prefix_hashes, range_hashes, sliding_least,
)

GRAM_WORDS = 2
STRETCH = 2
LEAST_COVERAGE = 0.8
# Diagonals this far apart belong to one alignment: words put in or left out.
BAND = 8
# Part of a template's grams that must hit before it is aligned.
LEAST_HITS = 0.3

# License notices in common use.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-notice": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so"
    ),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-text": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "gpl-2.0-text": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "mpl-2.0-text": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-4.0-text": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain."
    ),
}

# Words are runs of ASCII letters and digits and of all other characters beyond ASCII.
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")
_BLANKED = bytes(
    code if code >= 0x80 or chr(code).isalnum() else 0x20 for code in range(256)
)


def _words(raw: bytes) -> list[bytes]:
    return raw.lower().translate(_BLANKED).split()


def _pieces(raw: bytes) -> list[tuple[int, bytes]]:
    """The whole text as one piece, for an alignment may reach anywhere."""
    words = _words(raw)
    return [(0, b" ".join(words))] if len(words) >= GRAM_WORDS + STRETCH - 1 else []


def _block(texts: list[bytes], rows: list[int], before: list[int]) -> Block:
    data = b"\n".join(texts) + b"\n"
    letters = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero((letters == 32) | (letters == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    prefix = prefix_hashes(letters.astype(np.uint64) + np.uint64(1))
    hashes = mixed(range_hashes(prefix, starts, ends - starts))
    first = np.concatenate([[0], np.flatnonzero(letters[ends] == 10) + 1])
    return Block(data, starts, ends, hashes, first, np.array(rows), np.array(before))


UNITS = Units(GRAM_WORDS + STRETCH - 1, GRAM_WORDS, _pieces, _block)


class TemplateIndex:
    """Inverted index from gram hash to (template, place)."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: _words(text.encode()) for name, text in templates.items()}
        self.grams: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, words in self.words.items():
            if len(words) < GRAM_WORDS + STRETCH - 1:
                raise ValueError(f"template {name} has fewer than three words")
            for place, value in enumerate(gram_hashes(_block([b" ".join(words)], [0], [0]), GRAM_WORDS)):
                self.grams[int(value)].append((name, place))
        self.hashes = np.sort(np.fromiter(self.grams, np.uint64, len(self.grams)))

    def hits(self, block: Block) -> Iterator[tuple[int, dict[str, list[tuple[int, int]]]]]:
        """(text, template -> [(place in text, place in template)]) for texts with hits."""
        grams = gram_hashes(block, GRAM_WORDS)
        least = sliding_least(grams, STRETCH)
        kept = np.zeros(len(grams), bool)
        for step in range(STRETCH):
            kept[step : step + len(least)] |= grams[step : step + len(least)] == least
        near = np.minimum(np.searchsorted(self.hashes, grams), len(self.hashes) - 1)
        at = np.flatnonzero(kept & (self.hashes[near] == grams))
        doc = np.searchsorted(block.first, at, side="right") - 1
        inside = at + GRAM_WORDS <= block.first[doc + 1]
        found: dict[int, dict] = {}
        for place, number in zip(at[inside].tolist(), doc[inside].tolist()):
            own = found.setdefault(number, defaultdict(list))
            for name, where in self.grams[int(grams[place])]:
                own[name].append((place - int(block.first[number]), where))
        for number, own in found.items():
            yield number, own


@lru_cache(maxsize=2)
def _index(templates: tuple) -> TemplateIndex:
    return TemplateIndex(dict(templates))


def clusters(hits: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Hits grouped by diagonals, each group within BAND of its first.

    A place of the template that comes up again belongs to another copy of it.
    """
    out: list[list[tuple[int, int]]] = []
    low, seen = 0, set()
    for shift, place, where in sorted((place - where, place, where) for place, where in hits):
        if not out or shift - low > BAND or where in seen:
            out.append([])
            low, seen = shift, set()
        out[-1].append((place, where))
        seen.add(where)
    return out


def aligned(template: list[bytes], words: list[bytes], shift: int) -> tuple[int, int, int]:
    """(matches, first, end) of the best alignment with the words around ``shift``.

    Word i of the template is compared with words within BAND of ``shift + i``.
    """
    width = 2 * BAND + 1
    # Most matches, then the shortest stretch, then the one nearest to the hits.
    worth = lambda x: (x[0], x[1] - x[2], -abs(x[1] - shift))
    # Best (matches, first matched word, end of the last) per diagonal.
    best: list[tuple[int, int, int]] = [(0, -1, -1)] * width
    for i, word in enumerate(template):
        row: list[tuple[int, int, int]] = []
        for d in range(width):
            j = shift + i + d - BAND
            options = []
            if d + 1 < width:
                options.append(best[d + 1])  # a template word left out
            if row:
                options.append(row[-1])  # a word put in
            matches, first, last = best[d]
            if 0 <= j < len(words) and words[j] == word:
                options.append((matches + 1, first if first >= 0 else j, j + 1))
            else:
                options.append(best[d])
            row.append(max(options, key=worth))
        best = row
    return max(best, key=worth)


def _matches(
    index: TemplateIndex, words: list[bytes], hits: dict[str, list[tuple[int, int]]],
    least_coverage: float,
) -> dict[str, list[tuple[float, int, int]]]:
    """template -> [(coverage, first word, end)].

    Where matches overlap, the one with the most matched words less the words left over on
    either side stays, so a notice is not also reported as its shorter or near relative.
    """
    found = []
    for name, own in hits.items():
        template = index.words[name]
        need = max(1, int(LEAST_HITS * (len(template) - GRAM_WORDS + 1)))
        for group in clusters(own):
            if len({where for _, where in group}) < need:
                continue
            shifts = sorted(place - where for place, where in group)
            matches, first, end = aligned(template, words, shifts[len(shifts) // 2])
            if matches >= least_coverage * len(template):
                left_over = len(template) + (end - first) - 2 * matches
                found.append((left_over - matches, first, end, name, matches / len(template)))
    out: dict[str, list[tuple[float, int, int]]] = {}
    taken: list[tuple[int, int]] = []
    for _, first, end, name, coverage in sorted(found):
        if all(end <= low or high <= first for low, high in taken):
            taken.append((first, end))
            out.setdefault(name, []).append((coverage, first, end))
    return out


def scan_licenses(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    templates: dict[str, str] | None = None, least_coverage: float = LEAST_COVERAGE,
) -> DataFrame:
    """One row per document row and template found in it: id, ``license``, ``coverage``, ``spans``.

    ``coverage`` is the best share of the template's words that an alignment matches, and
    ``spans`` are the code points it covers, for every place with at least
    ``least_coverage``.  Null, empty and clean texts give no row; repeated rows give
    repeated rows.  The index has the size of the templates, whatever the data.
    """
    fixed = tuple((templates or TEMPLATES).items())
    TemplateIndex(dict(fixed))
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(fixed)
        for batch in batches:
            rows, names, coverages, spans = [], [], [], []
            texts = batch.column("text")
            for block in UNITS.blocks(texts):
                for number, hits in index.hits(block):
                    row = int(block.rows[number])
                    low, high = block.first[number], block.first[number + 1]
                    words = block.data[block.starts[low] : block.ends[high - 1]].split(b" ")
                    found = _matches(index, words, hits, least_coverage)
                    if not found:
                        continue
                    places = [match.span() for match in _WORD.finditer(texts[row].as_py())]
                    for name in sorted(found):
                        rows.append(row)
                        names.append(name)
                        coverages.append(max(match[0] for match in found[name]))
                        own = sorted((first, end) for _, first, end in found[name])
                        spans.append([
                            {"start": places[first][0], "end": places[end - 1][1]} for first, end in own
                        ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int64())), pa.array(names, pa.string()),
                 pa.array(coverages, pa.float64()), pa.array(spans, span)],
                names=["id", "license", "coverage", "spans"],
            )

    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(
        scan, f"id {kind}, license string, coverage double, spans array<struct<start:int,end:int>>"
    )
    return found.withColumnRenamed("id", id_column)
