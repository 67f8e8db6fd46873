"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.components import smallest_reachable, spanning_links
from tests.llm.frames import documents, empty, odd_rows


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, bits):
    """Smallest index reachable from each value over links of at most ``bits`` bits."""
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_like_brute_force_and_odd_rows(spark):
    random.seed(5)
    words = "alpha beta gamma delta eps zeta eta theta iota kappa".split()
    rows = [(100 + i, " ".join(random.choices(words, k=random.randint(1, 60)))) for i in range(25)]
    for i, (_, text) in enumerate(rows[:12]):
        edited = text.split()
        edited[random.randrange(len(edited))] = "Edited"
        rows.append((200 - i, " ".join(edited)))
    rows += odd_rows()
    found = simhash.near_duplicates(documents(spark, rows, clashes=True)).collect()
    prints = [plain_fingerprint(text) for _, text in rows]
    label = classes(prints, 4)
    ids = {}
    for (doc, _), own in zip(rows, label):
        ids.setdefault(own, []).append(doc)
    want = sorted(
        (str(doc), fp, str(min((x for x in ids[own] if x is not None), default=None)))
        for (doc, _), fp, own in zip(rows, prints, label)
    )
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in found) == want


@pytest.mark.parametrize("bits,block", [(4, 8), (4, 2048), (3, 8), (1, 8), (0, 8)])
def test_every_close_pair_is_connected(spark, monkeypatch, bits, block):
    monkeypatch.setattr(simhash, "SHORT_RUN", 4)
    random.seed(bits * 100 + block)
    centres = [random.getrandbits(64) for _ in range(4)] + [0, 2**64 - 1]
    values = set(centres)
    for centre in centres:  # clouds that chain beyond the distance
        for _ in range(40):
            near = centre
            for _ in range(random.randint(1, 5)):
                near ^= 1 << random.randrange(64)
            values.add(near)
    values = sorted(values)
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    keys = simhash.variant_keys(spark.createDataFrame(signed, "fp bigint"), bits)
    links = simhash.links_under_keys(keys, bits, block)
    roots = {r.node: r.root for r in smallest_reachable(links).collect()}
    got = {}
    for (fp,) in signed:
        got.setdefault(roots.get(fp, fp), set()).add(fp)
    want = {}
    for (fp,), own in zip(signed, classes(values, bits)):
        want.setdefault(own, set()).add(fp)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("batch", [3, 10, 50])
def test_links_of_a_key_cross_batches(spark, batch):
    random.seed(batch)
    values = []
    for _ in range(40):  # all under one key of the first segment, each with one partner
        value = random.getrandbits(43) << 21
        far = [random.sample(range(low, low + width), 2) for low, width in simhash.segments(4)[1:]]
        values += [value, value ^ sum(1 << bit for bits in far for bit in bits)]
    random.shuffle(values)
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    keys = simhash.variant_keys(spark.createDataFrame(signed, "fp bigint"), 4)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(batch))
    try:
        links = simhash.links_under_keys(keys, 4, 8).collect()
    finally:
        spark.conf.set(name, before)
    found = {frozenset((r.a % 2**64, r.b % 2**64)) for r in links}
    want = {frozenset((a, b)) for a in values for b in values if 0 < (a ^ b).bit_count() <= 4}
    assert len(want) == 40 and want <= found


def test_segments_hold_the_promise():
    for bits in range(5):
        parts = simhash.segments(bits)
        assert sum(width for _, width in parts) == 64 and bits < 2 * len(parts)


def test_forest_has_fewer_links_than_values():
    same = np.arange(50, dtype=np.uint64) & np.uint64(7)
    assert len(simhash.forest(same, same, 4)) == 49


def test_spanning_links_of_a_path():
    a, b = spanning_links(np.array([5, 3, 9, 7]), np.array([3, 9, 7, 20]))
    assert dict(zip(a.tolist(), b.tolist())) == {5: 3, 7: 3, 9: 3, 20: 3}


def test_one_document_of_each_group_stays(spark):
    text = "the quick brown fox jumps over the lazy dog and runs away from here"
    rows = [(3, text), (1, text), (2, "entirely other words stand in this one"), (9, text + " ")]
    kept = simhash.keep_one_each(documents(spark, rows, clashes=True))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert kept.columns == documents(spark, rows, clashes=True).columns


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
