"""Secret scans: patterns against a plain reading, structures against built encodings."""

import base64
import hashlib
import json
import os

import pytest

from ledgerloom.llm import secret_scan
from tests.llm.frames import documents, empty, odd_rows


def der(tag, body):
    if len(body) < 128:
        return bytes([tag, len(body)]) + body
    size = len(body).to_bytes((len(body).bit_length() + 7) // 8, "big")
    return bytes([tag, 0x80 | len(size)]) + size + body


def number(value):
    return der(2, value.to_bytes(value.bit_length() // 8 + 1, "big"))


RSA = der(0x30, number(0) + b"".join(number(3**k) for k in (400, 11, 390, 200, 210, 190, 180, 170)))
WRAPPED = der(0x30, number(0) + der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + b"\x05\x00") + der(4, RSA))
ELLIPTIC = der(0x30, number(1) + der(4, bytes(range(32))))
FIELDS = [b"none", b"none", b""]
SSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in FIELDS) + (1).to_bytes(4, "big")
SSH += b"".join(len(x).to_bytes(4, "big") + x for x in (b"public" * 8, b"private" * 16))


def url64(value):
    return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")


SIGNED = f"{url64({'alg': 'HS256'})}.{url64({'sub': 'x'})}.{'Ab1_' * 8}"


@pytest.mark.parametrize("key", [RSA, WRAPPED, ELLIPTIC, SSH])
def test_key_encodings(key):
    plain = base64.b64encode(key).decode()
    lines = "\n".join(plain[i : i + 64] for i in range(0, len(plain), 64))
    for written in (plain, lines, key.hex(), key.hex().upper()):
        text = f"see {written} end"
        spans = [s for s in secret_scan.find_secrets(text) if s[0] == "key"]
        assert len(spans) == 1 and spans[0][1] == 4
        assert abs(spans[0][2] - 4 - len(written.rstrip("="))) <= 1
    # One byte short, or an inner length that does not add up: no key.
    for broken in (key[:-1], key[:5] + bytes([key[5] ^ 0x55]) + key[6:]):
        text = f"see {base64.b64encode(broken).decode()} end"
        assert not [s for s in secret_scan.find_secrets(text) if s[0] == "key"]


def test_signed_tokens():
    assert ("signed", 2, 2 + len(SIGNED)) in secret_scan.find_secrets(f"a {SIGNED} b")
    headless = f"{url64({'typ': 'x'})}.{url64({})}.{'Ab1_' * 8}"
    for text in (headless, "www.example.com.something.else", "abcdefgh.ijklmnop.qrstuvwx"):
        assert not [s for s in secret_scan.find_secrets(text) if s[0] == "signed"]


def armoured(key, before="", after="\n", width=64):
    plain = base64.b64encode(key).decode()
    lines = [plain[i : i + width] for i in range(0, len(plain), width)]
    return "".join(before + line + after for line in ["-----BEGIN PRIVATE KEY-----", *lines, "-----END PRIVATE KEY-----"])


@pytest.mark.parametrize("key", [RSA, WRAPPED, ELLIPTIC, SSH])
@pytest.mark.parametrize(
    "before,after",
    [("", "\\n"), ("", "\\r\\n"), ("", "\\\\n"), ("", ""), ("    ", "\n"), ("\t", "\r\n"), ("> ", "\n"), ('  "', '\\n"\n')],
)
def test_key_files_in_other_files(key, before, after):
    text = 'say "' + armoured(key, before, after) + '" and go on'
    plain = base64.b64encode(key).decode().rstrip("=")
    (span,) = [s for s in secret_scan.find_secrets(text) if s[0] == "key"]
    assert span[1] == text.index(plain[:30])
    assert text[span[1] : span[2]].endswith(plain[-4:]) or abs(span[2] - text.rindex(plain[-4:]) - 4) <= 1
    assert plain[:20] not in secret_scan.redacted(text, "#") and plain[-20:] not in secret_scan.redacted(text, "#")


def test_keys_behind_other_characters():
    plain = base64.b64encode(RSA).decode()
    for text, at in ((f"key/AbC+{plain} x", 8), (f"abc{RSA.hex()} x", 3)):
        assert [s[1] for s in secret_scan.find_secrets(text) if s[0] == "key"] == [at]


def test_starts_of_keys_at_the_end():
    for n in range(60):
        for text in ("word M" + "I" * n, "word M" + "A" * n, "word " + base64.b64encode(SSH).decode()[:n]):
            assert not [s for s in secret_scan.find_secrets(text) if s[0] == "key"]
            assert not [s for s in secret_scan.find_secrets("x " + RSA.hex()[: n + 60]) if s[0] == "key"]


def test_signed_tokens_behind_dots_and_letters():
    for before in ("something.", "something.otherwise.", "Bearer-token_", "www.example-host.", "9."):
        assert ("signed", len(before), len(before + SIGNED)) in secret_scan.find_secrets(f"{before}{SIGNED} b")


def test_base_patterns():
    text = (
        'API_Key = "abcdefghijkl" password: token: abcdefghijkl1 PASSWD=short '
        "AKIAABCDEFGHIJKLMN AKIA123 deadbeefdeadbeef0 deadbeef tokeN:0123456789ab"
    )
    spans = secret_scan.base_spans(text)
    cut = [(kind, text[a:b]) for kind, a, b in spans]
    assert cut == [
        ("assign", 'API_Key = "abcdefghijkl'), ("assign", "tokeN:0123456789ab"),
        ("access", "AKIAABCDEFGHIJKLMN"), ("hex", "deadbeefdeadbeef0"),
    ]
    assert secret_scan.base_spans("paſſword=abcdefghijklmn toKen=abcdefghijklmn") == []


def test_query_digests(spark, tmp_path):
    from ledgerloom.llm.registry import QUERIES

    rows = [*odd_rows(), (50, f"é password=abcdefghijkl {SIGNED}")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op2_secrets"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    own = next(r for r in got if r.doc_id == 50)
    base = "assign:2:23"
    assert own.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert own.spans == f"{base},signed:24:{24 + len(SIGNED)}"
    assert (own.n_assign, own.n_access, own.n_hex) == (1, 0, 0)
    assert all(r.spans == "" for r in got if r.doc_id != 50)


def test_redaction(spark):
    rows = [(1, "x password=abcdefghijkl0 y"), (2, None), (3, "clean"), (4, "a" * 20)]
    done = secret_scan.redact_secrets(documents(spark, rows, clashes=True))
    out = {r.doc_id: (r.text, r.n_chars) for r in done.collect()}
    assert out == {
        1: ("x [secret] y", 12), 2: (None, None), 3: ("clean", 5), 4: ("[secret]", 8)
    }
    assert secret_scan.scan_secrets(empty(spark)).collect() == []


def test_random_bytes_are_no_key():
    for i in range(200):
        assert secret_scan.key_length(hashlib.sha512(bytes([i])).digest() * 4) == 0
    assert secret_scan.find_secrets(base64.b64encode(os.urandom(300)).decode()) is not None
