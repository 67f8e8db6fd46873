"""Embedding near-duplicates against all pairs in double precision."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import embedding_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int"
CLASHES = "id label_ vector node copies least width low high second links other root n_links component_id kept block met".split()


def all_pairs(rows, threshold=0.98):
    """Sorted (vec_id, n_links, component_id, kept)."""
    def able(vector, label):
        if label is None or vector is None or any(x is None for x in vector):
            return None
        full = np.array(vector, np.float32).astype(float)
        return full if len(full) and np.isfinite(full).all() and full.any() else None

    full = [able(vector, label) for _, vector, label in rows]
    near = [set() for _ in rows]
    for i, a in enumerate(full):
        for j in range(i):
            b = full[j]
            if a is None or b is None or len(a) != len(b) or rows[i][2] != rows[j][2]:
                continue
            a1, b1 = a / np.abs(a).max(), b / np.abs(b).max()
            if a1 @ b1 / np.sqrt((a1 @ a1) * (b1 @ b1)) >= threshold:
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vec_id, len(near[i]), least, vec_id == least))
    return in_order(out)


def in_order(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: tuple(map(str, row)))


def planted(seed=1, groups=25, width=16):
    """Chains and clouds of vectors around the threshold, copies, and far ones."""
    rng = np.random.default_rng(seed)
    rows, number = [], 0
    for _ in range(groups):
        base = rng.normal(size=width)
        for _ in range(int(rng.integers(1, 9))):
            step = rng.normal(size=width)
            step *= rng.uniform(0, 0.3) * np.linalg.norm(base) / np.linalg.norm(step)
            vector = [float(np.float32(x)) for x in (base + step) * rng.choice([1, 1, 1e-20, 1e15])]
            for _ in range(int(rng.choice([1, 1, 1, 3]))):
                rows.append((number, vector, int(rng.integers(0, 3)) if rng.random() < 0.3 else 1))
                number += 1
    rng.shuffle(rows)
    return [(int(i), v, int(label)) for i, v, label in rows]


ODD = [
    (9001, None, 1), (9002, [], 1), (9003, [0.0] * 16, 1), (9004, [1.0] * 15 + [None], 1),
    (9005, [1.0] * 15 + [float("nan")], 1), (9006, [1.0] * 15 + [float("inf")], 1), (9007, [1.0] * 16, None),
    (9008, [1.0] * 16, None), (None, [1.0] * 16, 5), (9009, [1.0] * 16, 5), (None, [2.0] * 16, 6),
    (None, [3.0] * 16, 6), (9010, [1.0], 1), (9011, [2.0], 1), (9012, [-1.0], 1), (9009, [1.0] * 16, 5),
    (9009, [0.0, -0.0] + [1.0] * 14, 7), (9013, [-0.0, 0.0] + [1.0] * 14, 7), (None, None, None),
]


def frame(spark, rows, clashes=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clashes:
        df = df.select("*", *[F.lit("x").alias(name) for name in CLASHES])
    return df


@pytest.mark.parametrize("clashes,block_rows", [(False, 1 << 14), (True, 16), (False, 1)])
def test_same_as_all_pairs(spark, clashes, block_rows):
    rows = planted(groups=25 if block_rows > 1 else 4) + ODD
    found = embedding_dedup.near_duplicates(frame(spark, rows, clashes), block_rows=block_rows)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert in_order(found.collect()) == all_pairs(rows)


def test_hot_label_of_near_copies_and_copies(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    rows = [(i, [float(np.float32(x)) for x in base + rng.normal(size=8) * 0.03], 1) for i in range(240)]
    rows += [(1000 + i, [float(np.float32(x)) for x in base], 1) for i in range(300)]
    rows += [(2000 + i, [float(np.float32(x)) for x in rng.normal(size=8)], 2) for i in range(60)]
    found = embedding_dedup.near_duplicates(frame(spark, rows), block_rows=64)
    assert in_order(found.collect()) == all_pairs(rows)


def test_double_vectors_of_any_size(spark):
    rows = [(1, [1e300, 1e300], 1), (2, [1e-300, 1e-300], 1), (3, [5e-324, 5e-324], 1), (4, [1.0, -1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = in_order(embedding_dedup.near_duplicates(df).collect())
    assert found == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]


@pytest.mark.parametrize("width", [1, 2, 64, 1500])
def test_error_bounds_hold(width):
    rng = random.Random(width)
    rng = np.random.default_rng(rng.randrange(1000))
    x = rng.normal(size=(300, width)) ** rng.choice([1, 3], size=(300, 1))
    x[150:] = x[:150] + rng.normal(size=(150, width)) * 0.1 * np.abs(x[:150]).max(axis=1)[:, None]
    q = embedding_dedup.Quantised(x)
    near = embedding_dedup.products(q, q, slice(0, 300), slice(0, 300)).astype(float)
    exact = (x / np.linalg.norm(x, axis=1)[:, None]) @ (x / np.linalg.norm(x, axis=1)[:, None]).T
    bound = q.error[:, None] + q.error[None] + q.error[:, None] * q.error[None] + embedding_dedup.ROUNDING
    assert (np.abs(near - exact) <= bound).all()
    assert np.abs(q.codes).max() == embedding_dedup.STEPS and (q.codes == np.rint(q.codes)).all()


def test_pairs_in_doubt_are_settled_in_full(monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.normal(size=32)
    x = base + rng.normal(size=(400, 32)) * np.linspace(0.02, 0.4, 400)[:, None]
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(i, j) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.98)) if i < j}
    real = embedding_dedup.cosines
    for share in (0.0, 1.0):  # all products again, and pair by pair
        monkeypatch.setattr(embedding_dedup, "DENSE_SHARE", share)
        q = embedding_dedup.Quantised(x)
        asked = []
        monkeypatch.setattr(embedding_dedup, "cosines", lambda a, b, i, j: asked.append(len(i)) or real(a, b, i, j))
        i, j = embedding_dedup.linked(q, q, slice(0, 400), slice(0, 400), 0.98)
        assert {(a, b) for a, b in zip(i, j) if a < b} == want
        assert share == 0.0 or 0 < sum(asked) < 400 * 400 / 4  # not all pairs


def test_empty_table(spark):
    assert embedding_dedup.near_duplicates(frame(spark, [])).collect() == []
    rows = [(1, None, 1), (2, [0.0], 1)]
    assert in_order(embedding_dedup.near_duplicates(frame(spark, rows)).collect()) == all_pairs(rows)
