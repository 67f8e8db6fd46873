"""String column helpers."""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named HTML entities and their code points, from the standard library's table; a
# non-breaking space is shown as a plain one.
ENTITIES = {**name2codepoint, "apos": 39, "nbsp": 32}

WHITESPACE = " \n\t\r"


def last_part(text: Column, mark: str = ".") -> Column:
    """Text after the last ``mark``; the whole text when there is none."""
    return F.substring_index(text, mark, -1)


def nth_part(text: Column, mark: str, position: int) -> Column:
    """``position``-th piece (from 1) of ``text`` cut at ``mark``; NULL when there are fewer."""
    pieces = F.split(text, "\\Q" + mark + "\\E", -1)
    return F.try_element_at(pieces, F.lit(position))


def full_name_parts(name: Column) -> list[Column]:
    """Given name, family name and patronymic of a ``family given patronymic`` text.

    A missing part is an empty text, as ``split_part`` gives.
    """
    return [
        F.split_part(name, F.lit(" "), F.lit(position)).alias(label)
        for label, position in (("first_name", 2), ("last_name", 1), ("patronymic", 3))
    ]


def strip(text: Column) -> Column:
    """Trim blanks, tabs and line ends on both sides."""
    return F.btrim(text, F.lit(WHITESPACE))


def remove(text: Column, *literals: str) -> Column:
    """Drop every occurrence of each literal."""
    return reduce(lambda acc, piece: F.replace(acc, F.lit(piece), F.lit("")), literals, text)


def remove_first(text: Column, letter: str) -> Column:
    """Drop the first occurrence of one character."""
    return F.regexp_replace(text, f"^([^{letter}]*){letter}", "$1")


def decimal_comma(text: Column) -> Column:
    """A number written with a decimal comma; NULL when it is not a number."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def _code_point(number: Column) -> Column:
    """Character of a number; the replacement character for what is none."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    shown = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(valid, shown).otherwise(F.lit("\ufffd"))


def _entity(piece: Column) -> Column:
    """Character of one entity; the piece itself when it is none."""
    names = F.create_map(*[F.lit(x) for name, code in ENTITIES.items() for x in (name, chr(code))])
    digits = F.regexp_extract(piece, r"^&#(\d{1,9});$", 1)
    hexed = F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]{1,8});$", 1)
    named = F.try_element_at(names, F.regexp_extract(piece, r"^&(\w+);$", 1))
    return (
        F.when(digits != "", _code_point(digits.try_cast("bigint")))
        .when(hexed != "", _code_point(F.conv(hexed, 16, 10).cast("bigint")))
        .otherwise(F.coalesce(named, piece))
    )


def decode_entities(text: Column) -> Column:
    """Replace HTML entities, named and numeric, by their characters, each once."""
    pieces = F.regexp_extract_all(text, F.lit(r"(?s)&#?\w+;|[^&]+|&"), F.lit(0))
    decoded = F.transform(
        pieces, lambda piece: F.when(piece.startswith("&"), _entity(piece)).otherwise(piece)
    )
    return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)


def find_all(text: Column, pattern: str, group: int = 1) -> Column:
    """All matches of one regex group, in text order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
