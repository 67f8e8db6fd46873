"""Random forest whose work is dealt out by row blocks and by tree nodes.

Features are cut into bins once.  Nodes with many rows are split by class counts that the
tasks sum over their own rows; a node that has become small is sent, with its rows, to one
task, which grows the rest of that subtree.  No task gets the rows or nodes of a whole tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import reliable_checkpoint, share_package, shuffle_width

BINS = 32
# A node with no more drawn rows than this is finished in one task.
FINISH_ROWS = 20_000
# Rows of a block, and drawn rows in the nodes of one finishing task, at most on average.
BLOCK_ROWS = 50_000
TASK_ROWS = 500_000
POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(13)])
# Votes are whole numbers, so that their sums do not depend on the order.
VOTE = 1 << 32
ROW, VALUES, LABEL = "__row", "__features", "__label"
# Kinds of a node that is not split.
GROWN, LEAF = -1, -2


class Top(NamedTuple):
    """The first nodes of all trees: tree ``t`` starts at node ``t``, right child follows left."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    counts: dict[int, np.ndarray]


class Forest(NamedTuple):
    assembler: VectorAssembler
    labels: list[str]
    cuts: list[np.ndarray]
    top: Top
    trees: int
    subtrees: DataFrame
    rows: int


def _drawn(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree's bootstrap sample holds each row: Poisson(1), by row and tree alone."""
    x = ids.astype(np.uint64) ^ np.uint64(((seed * 0x9E3779B1 + tree + 1) * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(POISSON, (x >> np.uint64(11)) / 2.0**53, side="right")


def _walked(feature, split, child, bins: np.ndarray, root: int) -> np.ndarray:
    """The last node on each row's way down."""
    at = np.full(len(bins), root)
    going = np.flatnonzero(feature[at] >= 0)
    while len(going):
        node = at[going]
        at[going] = child[node] + (bins[going, feature[node]] > split[node])
        going = going[feature[at[going]] >= 0]
    return at


def _picked(node: int, features: int, seed: int) -> np.ndarray:
    """The features a large node is split on: as many as the root of their number."""
    rng = np.random.default_rng([seed, node])
    return rng.choice(features, math.ceil(math.sqrt(features)), replace=False)


def _block(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = [batch for batch in batches if len(batch)]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()


def _matrix(blobs) -> np.ndarray:
    return np.stack([np.frombuffer(blob, np.uint8) for blob in blobs])


def _binned(values, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin number of every value: the cuts below it."""
    values = np.stack(values.to_numpy())
    return np.stack(
        [np.searchsorted(own, values[:, k]) for k, own in enumerate(cuts)], axis=1
    ).astype(np.uint8)


def _dealt(df: DataFrame, rows: int) -> DataFrame:
    """Blocks of rows, each with a number."""
    blocks = max(shuffle_width(df.sparkSession), math.ceil(rows / BLOCK_ROWS))
    return df.repartition(blocks).withColumn(ROW, F.monotonically_increasing_id())


def _cuts(df: DataFrame) -> list[np.ndarray]:
    """Bin borders: between all values of a feature with few, else at its quantiles."""
    few = VectorIndexer(inputCol=VALUES, outputCol="__few", maxCategories=BINS).fit(df)
    values = {int(k): sorted(map(float, v)) for k, v in dict(few.categoryMaps).items()}
    cuts = {k: (np.array(v[1:]) + np.array(v[:-1])) / 2 for k, v in values.items()}
    if len(cuts) < few.numFeatures:
        shares = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
        wanted = [k for k in range(few.numFeatures) if k not in cuts]
        each = df.select(F.posexplode(vector_to_array(VALUES)).alias("k", "x"))
        if cuts:
            each = each.filter(F.col("k").isin(wanted))
        found = each.groupBy("k").agg(F.percentile_approx("x", shares).alias("cuts"))
        cuts |= {row["k"]: np.unique(row["cuts"]) for row in found.collect()}
    return [cuts[k] for k in range(few.numFeatures)]


def _best(counts: np.ndarray) -> tuple[int, int, np.ndarray] | None:
    """Feature number, last left bin and left counts of the purest split; None without gain."""
    left = counts.cumsum(1)[:, :-1]
    total = counts[0].sum(0)
    n_left, n = left.sum(2), total.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (left**2.0).sum(2) / n_left + ((total - left) ** 2.0).sum(2) / (n - n_left)
    score = np.where((n_left > 0) & (n_left < n), score, -1)
    k, split = np.unravel_index(score.argmax(), score.shape)
    if score[k, split] <= (total**2.0).sum() / n + 1e-9 * n:
        return None
    return int(k), int(split), left[k, split]


def _top(
    rows: DataFrame, n: int, features: int, classes: int, trees: int, depth: int, seed: int
) -> Top:
    """Split all nodes with many rows, level by level, by class counts summed over the blocks."""
    feature, split, child, level = [GROWN] * trees, [0] * trees, [0] * trees, [0] * trees
    owner, counts = list(range(trees)), {}
    opened = list(range(trees)) if n > FINISH_ROWS and depth > 0 else []
    many = math.ceil(math.sqrt(features))
    while opened:
        now = [np.array(x) for x in (feature, split, child)]
        by_tree: dict[int, list[int]] = {}
        for node in opened:
            by_tree.setdefault(owner[node], []).append(node)

        def counted(batches, now=now, by_tree=by_tree):
            block = _block(batches)
            if not len(block):
                return
            bins, ids, label = _matrix(block["bins"]), block[ROW].to_numpy(), block[LABEL].to_numpy()
            for tree, nodes in by_tree.items():
                weight = _drawn(ids, tree, seed)
                at = _walked(*now, bins, tree)
                place = np.full(len(now[0]), -1)
                place[nodes] = np.arange(len(nodes))
                use = np.flatnonzero((weight > 0) & (place[at] >= 0))
                slot = place[at[use]]
                picks = np.stack([_picked(node, features, seed) for node in nodes])
                cell = slot[:, None] * many + np.arange(many)
                cell = (cell * BINS + bins[use[:, None], picks[slot]]) * classes + label[use, None]
                cells = np.bincount(
                    cell.ravel(), np.repeat(weight[use], many), len(nodes) * many * BINS * classes
                ).astype(np.int64).reshape(len(nodes), -1)
                yield pd.DataFrame({"node": nodes, "cells": [one.tobytes() for one in cells]})

        def chosen(pdf):
            cells = sum(np.frombuffer(one, np.int64) for one in pdf["cells"])
            cells = cells.reshape(many, BINS, classes)
            node, best, total = int(pdf["node"].iloc[0]), _best(cells), cells[0].sum(0)
            k, at, left = best or (-1, 0, total)
            number = -1 if k < 0 else int(_picked(node, features, seed)[k])
            return pd.DataFrame(
                {"node": [node], "feature": [number], "split": [at], "left": [left], "right": [total - left]}
            )

        found = (
            rows.mapInPandas(counted, "node int, cells binary").groupBy("node")
            .applyInPandas(chosen, "node int, feature int, split int, left array<bigint>, right array<bigint>")
        )
        opened = []
        for row in found.orderBy("node").collect():
            node = row["node"]
            if row["feature"] < 0:
                feature[node], counts[node] = LEAF, np.array(row["left"])
                continue
            feature[node], split[node], child[node] = row["feature"], row["split"], len(feature)
            for own in (np.array(row["left"]), np.array(row["right"])):
                new, done = len(feature), own.max() == own.sum() or level[node] + 1 >= depth
                feature.append(LEAF if done else GROWN)
                split.append(0), child.append(0), owner.append(owner[node]), level.append(level[node] + 1)
                if done:
                    counts[new] = own
                elif own.sum() > FINISH_ROWS:
                    opened.append(new)
    return Top(*(np.array(x) for x in (feature, split, child, level)), counts)


def _grow(bins, label, weight, classes: int, depth: int, rng) -> dict[str, np.ndarray]:
    """A subtree as arrays: a leaf has feature -1, its classes from ``child``, ``split`` of them."""
    many = math.ceil(math.sqrt(bins.shape[1]))
    rows, at, k, made = np.arange(len(bins)), np.zeros(len(bins), int), 1, 1
    levels, kinds, shares, held = [], [], [], 0
    for left_over in range(depth, -1, -1):
        total = np.bincount(at * classes + label[rows], weight[rows], k * classes).reshape(k, classes)
        size = total.sum(1)
        parent = (total**2).sum(1) / size
        feature, split, child = np.full(k, -1), np.zeros(k, int), np.zeros(k, int)
        mixed = total.max(1) < size
        if left_over and mixed.any():
            keep = mixed[at]
            rows, at = rows[keep], at[keep]
            picks = rng.random((k, bins.shape[1])).argsort(1)[:, :many]
            best = parent + 1e-9 * size
            for j in range(many):
                key = at * 256 + bins[rows, picks[at, j]]
                order = np.argsort(key, kind="stable")
                key, node, own = key[order], at[order], rows[order]
                hot = np.zeros((len(own), classes))
                hot[np.arange(len(own)), label[own]] = weight[own]
                first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
                sums = hot.cumsum(0)
                before = np.zeros((k, classes))
                before[node[first]] = sums[first] - hot[first]
                end = np.flatnonzero(np.r_[(key[1:] != key[:-1]) & (node[1:] == node[:-1]), False])
                if not len(end):
                    continue
                node, cut = node[end], key[end] & 255
                left = sums[end] - before[node]
                n_left = left.sum(1)
                score = (left**2).sum(1) / n_left + ((total[node] - left) ** 2).sum(1) / (size[node] - n_left)
                first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
                top = np.full(k, -1.0)
                top[node[first]] = np.maximum.reduceat(score, first)
                hit = np.flatnonzero(score == top[node])[::-1]
                place = np.zeros(k, int)
                place[node[hit]] = cut[hit]
                won = top > best
                best[won], feature[won], split[won] = top[won], picks[won, j], place[won]
        inner = feature >= 0
        child[inner] = made + 2 * np.arange(inner.sum())
        leaf, kind = np.nonzero(total * ~inner[:, None])
        each = np.bincount(leaf, minlength=k)
        split[~inner] = each[~inner]
        child[~inner] = held + (np.cumsum(each) - each)[~inner]
        kinds.append(kind), shares.append(total[leaf, kind] / size[leaf])
        held += len(kind)
        levels.append((feature, split, child))
        keep = inner[at]
        rows, at = rows[keep], at[keep]
        if not len(rows):
            break
        at = child[at] - made + (bins[rows, feature[at]] > split[at])
        k = 2 * int(inner.sum())
        made += k
    feature, split, child = (np.concatenate(x).astype(np.int32) for x in zip(*levels))
    votes = np.rint(np.concatenate(shares) * VOTE).astype(np.int64)
    return {
        "feature": feature, "split": split, "child": child,
        "kinds": np.concatenate(kinds).astype(np.int32), "votes": votes,
    }


SUBTREE = {"feature": np.int32, "split": np.int32, "child": np.int32, "kinds": np.int32, "votes": np.int64}


def _parts(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of equal values, by value."""
    order = np.argsort(at, kind="stable")
    if len(order):
        for own in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
            yield int(at[own[0]]), own


def fit_forest(
    df: DataFrame, features: list[str], target: str, trees: int, max_depth: int, seed: int
) -> Forest:
    """Grow all trees on all rows; the subtrees are kept as a table."""
    share_package(df.sparkSession)
    indexer = StringIndexer(inputCol=target, outputCol=LABEL, stringOrderType="alphabetAsc").fit(df)
    assembler = VectorAssembler(inputCols=features, outputCol=VALUES)
    ready = assembler.transform(indexer.transform(df)).select(VALUES, F.col(LABEL).cast("int").alias(LABEL))
    n, classes, width = df.count(), len(indexer.labels), shuffle_width(df.sparkSession)
    cuts = _cuts(ready)

    def coded(batches):
        for batch in batches:
            if len(batch):
                bins = [one.tobytes() for one in _binned(batch[VALUES], cuts)]
                yield pd.DataFrame({ROW: batch[ROW], LABEL: batch[LABEL], "bins": bins})

    dealt = _dealt(ready.select(vector_to_array(VALUES).alias(VALUES), LABEL), n)
    rows = reliable_checkpoint(dealt.mapInPandas(coded, f"{ROW} bigint, {LABEL} int, bins binary"))
    top = _top(rows, n, len(cuts), classes, trees, max_depth, seed)

    def sent(batches):
        block = _block(batches)
        if not len(block):
            return
        bins, ids, label = _matrix(block["bins"]), block[ROW].to_numpy(), block[LABEL].to_numpy()
        for tree in range(trees):
            weight = _drawn(ids, tree, seed)
            at = _walked(top.feature, top.split, top.child, bins, tree)
            use = np.flatnonzero((weight > 0) & (top.feature[at] == GROWN))
            for node, own in _parts(at[use]):
                own = use[own]
                yield pd.DataFrame({
                    "node": [node], "bins": [bins[own].tobytes()],
                    "label": [label[own].astype(np.int32).tobytes()],
                    "weight": [weight[own].astype(np.uint8).tobytes()],
                })

    def grown(pdf):
        node = int(pdf["node"].iloc[0])
        # The order of the rows changes no count, so neither does the order of the blocks.
        bins, label, weight = (
            np.frombuffer(b"".join(pdf[name]), kind)
            for name, kind in (("bins", np.uint8), ("label", np.int32), ("weight", np.uint8))
        )
        tree = _grow(
            bins.reshape(len(label), -1), label, weight.astype(float), classes,
            max_depth - int(top.depth[node]), np.random.default_rng([seed, node, 1]),
        )
        return pd.DataFrame({"node": [node], **{name: [x.tobytes()] for name, x in tree.items()}})

    tasks = max(width, math.ceil(n * trees / TASK_ROWS))
    subtrees = reliable_checkpoint(
        rows.mapInPandas(sent, "node int, bins binary, label binary, weight binary")
        .repartition(tasks, "node").groupBy("node")
        .applyInPandas(grown, "node int, " + ", ".join(f"{name} binary" for name in SUBTREE))
    )
    return Forest(assembler, indexer.labels, cuts, top, trees, subtrees, n)


def forest_predict(model: Forest, df: DataFrame) -> DataFrame:
    """The rows with a ``predicted`` class: the largest sum of the leaves' class shares."""
    share_package(df.sparkSession)
    n, width = df.count(), shuffle_width(df.sparkSession)
    ready = model.assembler.transform(df)
    rows = reliable_checkpoint(_dealt(ready, n))
    top, cuts, trees = model.top, model.cuts, model.trees
    # Rows of as many blocks as the model was fitted on share one reading of it.
    slices = max(1, math.ceil(n / max(model.rows, 1)))

    def sent(batches):
        block = _block(batches)
        if not len(block):
            return
        bins, ids = _binned(block[VALUES], cuts), block[ROW].to_numpy()
        part = TaskContext.get().partitionId()
        for tree in range(trees):
            for node, own in _parts(_walked(top.feature, top.split, top.child, bins, tree)):
                leaf = top.feature[node] == LEAF
                yield pd.DataFrame({
                    "node": [node], "slice": [-1 - part if leaf else part % slices],
                    "ids": [ids[own].tobytes()], "bins": [b"" if leaf else bins[own].tobytes()],
                })

    def voted(subtree, blocks):
        if not len(blocks):
            return pd.DataFrame({"row": [], "class": [], "votes": []})
        ids, node = np.frombuffer(b"".join(blocks["ids"]), np.int64), int(blocks["node"].iloc[0])
        if node in top.counts:
            kinds = np.flatnonzero(top.counts[node])
            votes = np.rint(top.counts[node][kinds] / top.counts[node].sum() * VOTE).astype(np.int64)
            many, start = np.full(len(ids), len(kinds)), np.zeros(len(ids), int)
        else:
            tree = {name: np.frombuffer(subtree[name].iloc[0], kind) for name, kind in SUBTREE.items()}
            kinds, votes = tree["kinds"], tree["votes"]
            bins = np.frombuffer(b"".join(blocks["bins"]), np.uint8).reshape(len(ids), -1)
            at = _walked(tree["feature"], tree["split"], tree["child"], bins, 0)
            many, start = tree["split"][at], tree["child"][at]
        take = np.repeat(start - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return pd.DataFrame({"row": np.repeat(ids, many), "class": kinds[take], "votes": votes[take]})

    tasks = max(width, math.ceil(n * trees / TASK_ROWS))
    blocks = (
        rows.select(ROW, vector_to_array(VALUES).alias(VALUES))
        .mapInPandas(sent, "node int, slice int, ids binary, bins binary")
        .repartition(tasks, "node", "slice")
    )
    each = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    subtrees = model.subtrees.withColumn("slice", each).repartition(tasks, "node", "slice")
    votes = (
        subtrees.groupBy("node", "slice").cogroup(blocks.groupBy("node", "slice"))
        .applyInPandas(voted, "row bigint, class int, votes bigint")
        .groupBy("row", "class").agg(F.sum("votes").alias("votes"))
    )
    most = votes.groupBy(F.col("row").alias(ROW)).agg(
        F.max_by("class", F.struct("votes", -F.col("class"))).cast("double").alias("__index")
    )
    names = IndexToString(inputCol="__index", outputCol="predicted", labels=model.labels)
    return names.transform(rows.join(most, ROW)).select(*df.columns, "predicted")
