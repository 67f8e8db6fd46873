"""Fill-in-the-middle: a text is cut in prefix, middle and suffix, which change places.

One match of ``(unit)*`` over the whole text keeps every repetition of its group: the ends
of that group are the ends of all units, so their number and both cut offsets come from
one list, without a loop over units.  Where to cut, and in which form to write, are drawn
from a digest of the seed and the document id, so a retried task writes the same text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
FORMS = ("plain", "psm", "spm")
SEED = 1
# Percent of the texts with plain form, and of the others with the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20
CODE_POINT = "."
# Units that one match may hold: its captures take about 150 bytes each.  Longer texts
# are matched in stretches of so many units, each from the end of the one before.
MATCH_UNITS = 1 << 18
RESULT = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"
_RESULT_ARROW = pa.struct([
    ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("output", pa.string()),
])


class Cutter:
    """Ends of the units of a text; a unit is never matched in another way to fit the rest."""

    def __init__(self, unit: str = CODE_POINT, match_units: int = MATCH_UNITS):
        if regex.fullmatch(unit, ""):
            raise ValueError(f"a unit has at least one character: {unit!r}")
        self.match_units = match_units
        self.whole = regex.compile(f"((?>{unit}))*", regex.DOTALL)
        self.stretch = regex.compile(f"((?>{unit})){{0,{match_units}}}", regex.DOTALL)

    def ends(self, text: str) -> np.ndarray:
        """End of every unit; characters at the end that no unit matches are one more."""
        if len(text) <= self.match_units:
            match = self.whole.fullmatch(text)
            if match is not None:
                return np.array(match.ends(1), np.int64)
        parts, at = [], 0
        while at < len(text):
            found = np.array(self.stretch.match(text, at).ends(1), np.int64)
            if not len(found):  # no unit matches here
                found = np.array([len(text)], np.int64)
            parts.append(found)
            at = int(found[-1])
        return np.concatenate(parts) if parts else np.empty(0, np.int64)


def rearranged(
    text: str | None, digest: str, cutter: Cutter, marks: tuple[str, str, str] = MARKS,
    plain_percent: int = PLAIN_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> dict:
    """The text in its new order.  ``digest``: at least 32 hex digits, four draws of eight.

    Plain, with null lengths: empty and null texts, texts that hold a mark, the share drawn
    to stay plain, and texts whose parts would form a mark across a border.
    """
    text = text or ""
    ends = cutter.ends(text)
    first, second, shape, order = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    plain = {"n": len(ends), "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    if not text or shape % 100 >= 100 - plain_percent or any(mark in text for mark in marks):
        return plain
    cuts = sorted((first % (len(ends) + 1), second % (len(ends) + 1)))
    low, high = (int(ends[cut - 1]) if cut else 0 for cut in cuts)
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if order % 100 < suffix_first_percent:
        form, output = "spm", f"{marks[1]}{suffix}{marks[0]}{prefix}{marks[2]}{middle}"
    else:
        form, output = "psm", f"{marks[0]}{prefix}{marks[1]}{suffix}{marks[2]}{middle}"
    if any(output.count(mark) > 1 for mark in marks):
        return plain
    return {"n": len(ends), "form": form, "prefix_chars": low, "middle_chars": high - low, "output": output}


def draws(id_column: Column, seed: int = SEED) -> Column:
    """Hex digest of ``seed:id``; a null id is written as nothing."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    return F.sha2(name.cast("binary"), 256)


def transform(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED,
    unit: str = CODE_POINT, marks: tuple[str, str, str] = MARKS,
    plain_percent: int = PLAIN_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
    match_units: int = MATCH_UNITS,
) -> DataFrame:
    """One row per document row: id, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``unit`` is a pattern that matches one unit at the place it is tried: a code point
    (default), or for instance a word with the white space behind it.  Lengths are in code
    points and null for plain texts.  Null and empty texts have no unit and give an empty
    plain output.  Equal draws cut nothing out: the middle is empty.  Repeated rows give
    repeated rows; rows with one id share their draws.  No other column is read.
    """
    marks = tuple(marks)
    Cutter(unit)  # refuses a unit that may be empty before any task runs

    @F.arrow_udf(RESULT)
    def apply(texts: pa.Array, digests: pa.Array) -> pa.Array:
        cutter = Cutter(unit, match_units)
        rows = [
            rearranged(text, digest, cutter, marks, plain_percent, suffix_first_percent)
            for text, digest in zip(texts.to_pylist(), digests.to_pylist())
        ]
        return pa.array(rows, _RESULT_ARROW)

    cut = apply(F.col(text_column), draws(F.col(id_column), seed)).alias("cut")
    return docs.select(F.col(id_column), cut).select(id_column, "cut.*")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``transform`` was given, from its output and form alone."""
    p, s, m = marks
    between = lambda start, end: F.substring_index(F.substring_index(output, end, 1), start, -1)
    middle = F.substring_index(output, m, -1)
    return (
        F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
        .when(form == "spm", F.concat(between(p, m), middle, between(s, p)))
        .otherwise(output)
    )
