"""License scans: exact, edited and missing notices."""

import random

import pytest

from ledgerloom.llm import license_scan
from tests.llm.frames import documents, empty, odd_rows

WORDS = "of the and in to license free use software this under version a is for".split()


def filler(n):
    return " ".join(random.choices(WORDS, k=n))


def test_every_template_is_found_where_it_stands(spark):
    random.seed(1)
    rows = []
    for i, text in enumerate(license_scan.TEMPLATES.values()):
        rows.append((1000 + i, f"{filler(30)} ünder\n{text.upper()}\n{filler(30)}"))
        rows.append((5000 + i, filler(200)))
    rows += odd_rows()
    found = license_scan.scan_licenses(documents(spark, rows, clashes=True)).collect()
    texts = dict(rows)
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, (name, text) in enumerate(license_scan.TEMPLATES.items()):
        best = max(by_doc[1000 + i], key=lambda r: (r.coverage, len(r.spans)))
        own = next(r for r in by_doc[1000 + i] if r.license == name)
        assert own.coverage == 1.0 and best.coverage == 1.0
        cut = [texts[1000 + i][s.start : s.end] for s in own.spans]
        assert any(text.upper().strip('."').endswith(c.strip('."')[-9:]) or c in text.upper() for c in cut)
    assert not [doc for doc in by_doc if doc is None or not 1000 <= doc < 5000]


def test_edits_lower_the_coverage(spark):
    words = license_scan.TEMPLATES["mit-text"].split()
    edited = words[:10] + ["really", "quite"] + words[10:30] + words[33:]
    broken = words[:30]
    rows = [(1, " ".join(edited)), (2, " ".join(broken)), (3, " ".join(words) + " x " + " ".join(words))]
    got = {r.doc_id: r for r in license_scan.scan_licenses(documents(spark, rows)).collect()}
    assert set(got) == {1, 3}
    assert got[1].coverage == pytest.approx((len(words) - 3) / len(words), abs=0.02)
    assert len(got[3].spans) == 2


def test_notices_in_a_row(spark):
    text = "All rights reserved. " * 4 + "Licensed under CC BY-NC 4.0."
    got = {r.license: r.spans for r in license_scan.scan_licenses(documents(spark, [(1, text)])).collect()}
    assert len(got["all-rights-reserved"]) == 4 and set(got) == {"all-rights-reserved", "cc-by-nc-4.0-notice"}


def test_empty_and_short_templates(spark):
    assert license_scan.scan_licenses(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        license_scan.scan_licenses(empty(spark), templates={"x": "two words"})
