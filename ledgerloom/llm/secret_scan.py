"""Secrets in texts: pattern candidates, and candidates whose decoded structure confirms them.

Three base kinds are plain patterns.  Two more kinds are found by decoding: a base64 or
hex candidate is reported as ``key`` only if its bytes parse as a private-key encoding
whose nested lengths add up, and a dotted triple as ``signed`` only if its header and
payload are JSON objects and the header names an algorithm.  Candidates are tried from
every place where one may start, not only from the first character of a run.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Order decides between spans with one start.
KINDS = ("assign", "access", "hex", "key", "signed")
BASE_KINDS = KINDS[:3]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of hex digits is one match of [0-9a-f]+, so asking for the length changes nothing.
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)
# Where a key may start, inside a run of other characters too: the base64 and hex digits
# of a sequence tag with its length, or of the name of the container.
KEY_START = re.compile(r"M(?=[A-I])|b(?=3BlbnNzaC1r)")
HEX_KEY_START = re.compile(r"3(?=0[0-9A-Fa-f]{62})|6(?=[fF]70656[eE]7373682[dD][0-9A-Fa-f]{42})")
ENCODED = re.compile(r"[A-Za-z0-9+/_-]+")
HEX_ENCODED = re.compile(r"[0-9A-Fa-f]+")
# Between the lines of an armoured file: line breaks, written out or escaped, with the
# indentation and quote marks around them.
LINE_BREAK = re.compile(r"""["'>\x20\t]*(?:(?:\\+[rn]|\\*[\r\n])["'>\x20\t]*)+""")
# Characters of a key candidate decoded first; more follow as its lengths ask for them.
HEAD = 32
# Segment by segment: what two more follow, of which the first may be a payload.
SIGNED = re.compile(
    r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.(?=([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{8,}))"
)
# Where a header may start inside its segment: an object that opens with a name.
HEADER_START = re.compile(r"^|e(?=[w-z0-9])")
SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
)

# ASN.1 tags used by key encodings.
_SEQUENCE, _INTEGER, _OCTETS, _OID = 0x30, 0x02, 0x04, 0x06
_OPENSSH = b"openssh-key-v1\0"


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the DER element at ``at`` if it lies within ``end``."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length & 0x80:
        width = length & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        length, at = int.from_bytes(data[at : at + width], "big"), at + width
    return (tag, at, at + length) if at + length <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Elements that fill ``start`` to ``end`` exactly."""
    found = []
    while start < end:
        element = _element(data, start, end)
        if element is None:
            return None
        found.append(element)
        start = element[2]
    return found


def der_key_length(data: bytes) -> int:
    """Bytes of the private key in DER that ``data`` starts with, or 0.

    Accepts a key with its numbers in one sequence (version, then eight integers, or five
    for the older discrete-log form), one wrapped with its algorithm, and an elliptic one.
    """
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != _SEQUENCE:
        return 0
    parts = _children(data, outer[1], outer[2])
    if not parts or len(parts) < 2 or parts[0][0] != _INTEGER:
        return 0
    version = int.from_bytes(data[parts[0][1] : parts[0][2]], "big")
    tags = [tag for tag, _, _ in parts]
    if version <= 1 and len(tags) in (6, 9) and set(tags) == {_INTEGER}:
        return outer[2]
    if version == 1 and tags[1] == _OCTETS and parts[1][2] - parts[1][1] >= 16:
        return outer[2]
    if version <= 1 and len(tags) >= 3 and tags[1:3] == [_SEQUENCE, _OCTETS]:
        algorithm = _children(data, parts[1][1], parts[1][2])
        inner = _element(data, parts[2][1], parts[2][2])
        if algorithm and algorithm[0][0] == _OID and inner and inner[2] == parts[2][2]:
            return outer[2]
    return 0


def openssh_key_length(data: bytes) -> int:
    """Bytes of the length-prefixed private-key container ``data`` starts with, or 0."""
    if not data.startswith(_OPENSSH):
        return 0
    at = len(_OPENSSH)

    def field(at: int) -> int:
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        return end if at + 4 <= len(data) and end <= len(data) else 0

    for _ in range(3):  # cipher, key derivation, its options
        if not (at := field(at)):
            return 0
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return 0
    for _ in range(keys + 1):  # public keys, then the private section
        if not (at := field(at)):
            return 0
    return at


def key_length(data: bytes) -> int:
    return der_key_length(data) or openssh_key_length(data)


def _base64(text: str) -> bytes:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return b""


def _encoded(text: str, at: int, most: int) -> tuple[str, list[tuple[int, int]]]:
    """Up to ``most`` base64 characters from ``at`` on, over line breaks.

    Also (characters before, place in the text) of each line.
    """
    parts, lines, n = [], [], 0
    while n < most and (line := ENCODED.match(text, at, at + most - n)):
        parts.append(line[0])
        lines.append((n, at))
        n += len(line[0])
        gap = LINE_BREAK.match(text, line.end())
        if not gap:
            break
        at = gap.end()
    return "".join(parts), lines


def _bytes_needed(head: bytes) -> int:
    """Bytes of the key that ``head`` may start, 0 if it starts none, -1 if only parsing tells."""
    if head.startswith(_OPENSSH):
        return -1
    outer = _element(head, 0, 1 << 62) if len(head) > 1 else None
    if outer is None or outer[0] != _SEQUENCE or head[outer[1] : outer[1] + 1] != b"\x02":
        return 0
    return outer[2]


def _base64_key_end(text: str, at: int) -> int:
    """End of the base64 of a private key that starts at ``at``, or 0."""
    need = _bytes_needed(_base64(_encoded(text, at, HEAD)[0]))
    if not need or need > len(text) - at:
        return 0
    most = -(-need * 4 // 3) if need > 0 else len(text)
    body, lines = _encoded(text, at, most)
    length = key_length(_base64(body))
    if not length:
        return 0
    last = -(-length * 4 // 3) - 1
    before, start = next(line for line in reversed(lines) if line[0] <= last)
    return start + last - before + 1


def _hex_key_end(text: str, at: int) -> int:
    """End of the hex of a private key that starts at ``at``, or 0."""
    need = _bytes_needed(bytes.fromhex(text[at : at + HEAD]))
    if not need or 2 * need > len(text) - at:
        return 0
    digits = HEX_ENCODED.match(text, at, at + 2 * need if need > 0 else len(text))[0]
    length = key_length(bytes.fromhex(digits[: len(digits) // 2 * 2]))
    return at + 2 * length if length else 0


def _json_object(text: str) -> dict | None:
    try:
        value = json.loads(_base64(text))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of decodable candidates whose structure holds."""
    found = []
    for starts, end_of in ((KEY_START, _base64_key_end), (HEX_KEY_START, _hex_key_end)):
        done = 0
        for match in starts.finditer(text):
            if match.start() >= done and (end := end_of(text, match.start())):
                found.append(("key", match.start(), end))
                done = end
    done = 0
    for match in SIGNED.finditer(text):
        if match.start() < done or _json_object(match[2]) is None:
            continue
        for start in HEADER_START.finditer(match[1]):
            header = _json_object(match[1][start.start() :])
            if header and isinstance(header.get("alg"), str):
                done = match.end(3)
                found.append(("signed", match.start() + start.start(), done))
                break
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three plain patterns, leftmost and non-overlapping per kind."""
    found = [
        ("assign", *match.span())
        for match in ASSIGN.finditer(text)
        if len(match[2]) >= ASSIGN_VALUE
    ]
    found += [
        ("access", *match.span())
        for match in ACCESS.finditer(text)
        if match.end() - match.start() >= ACCESS_LENGTH
    ]
    return found + [("hex", *match.span()) for match in HEX.finditer(text)]


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind; code points, end exclusive."""
    if not text:
        return []
    found = base_spans(text) + confirmed_spans(text)
    return sorted(set(found), key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def redacted(text: str | None, mask: str) -> str | None:
    """The text with every span (overlapping ones as one) replaced by ``mask``."""
    if not text:
        return text
    out, at = [], 0
    for _, start, end in find_secrets(text):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secret_spans(text: Column) -> Column:
    """Array of (kind, start, end) per text; empty for null and for clean texts."""

    @F.arrow_udf(SPANS)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array(
            [
                [{"kind": kind, "start": start, "end": end} for kind, start, end in find_secrets(t)]
                for t in texts.to_pylist()
            ],
            _SPANS_ARROW,
        )

    return find(text)


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id and ``spans``.  Repeated rows give repeated rows."""
    return docs.select(F.col(id_column), secret_spans(F.col(text_column)).alias("spans"))


def redact_secrets(
    docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars",
    mask: str = "[secret]",
) -> DataFrame:
    """The same rows with secrets masked in the text, and the length column kept in step.

    Null stays null; texts without secrets stay as they are.
    """

    @F.arrow_udf("string")
    def hide(texts: pa.Array) -> pa.Array:
        return pa.array([redacted(t, mask) for t in texts.to_pylist()], pa.string())

    masked = docs.withColumn(text_column, hide(F.col(text_column)))
    if length_column in docs.columns:
        changed = F.length(text_column).cast(docs.schema[length_column].dataType)
        masked = masked.withColumn(length_column, changed)
    return masked
