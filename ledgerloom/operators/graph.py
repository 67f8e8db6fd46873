"""Transfer graphs: edges, node and edge attributes, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerloom.functions.scoring import EDGE_WIDTHS, WIDEST_EDGE, step_score
from ledgerloom.operators.ordering import approximate_quantiles, exact_quantiles
from ledgerloom.operators.skew import heavy_of, skew_safe_join, top_hashes
from ledgerloom.session import (
    measured_checkpoint, reliable_checkpoint, remove_path, shuffle_width,
)

# Colour and size of a drawn sender and receiver.
SENDER_LOOK = ("blue", 300)
RECEIVER_LOOK = ("red", 500)


def aggregate_edges(transfers: DataFrame, sender: str, receiver: str, amount: str) -> DataFrame:
    """One edge per (sender, receiver) with the summed amount: ``src``, ``dst``, ``amount``."""
    return (
        transfers.dropna(subset=[sender, receiver])
        .groupBy(F.col(sender).alias("src"), F.col(receiver).alias("dst"))
        .agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias("amount"))
    )


def node_roles(edges: DataFrame) -> DataFrame:
    """Every node with colour, size and label; a node that receives looks like a receiver."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("node"), F.lit(False).alias("receives")),
                F.struct(F.col("dst").alias("node"), F.lit(True).alias("receives")),
            )
        ).alias("end")
    ).select("end.*")
    nodes = ends.groupBy("node").agg(F.bool_or("receives").alias("is_receiver"))
    look = [
        F.when(F.col("is_receiver"), F.lit(receiver)).otherwise(F.lit(sender)).alias(name)
        for name, receiver, sender in zip(("color", "size"), RECEIVER_LOOK, SENDER_LOOK)
    ]
    return nodes.select("node", "is_receiver", *look, F.col("node").cast("string").alias("label"))


def graph_size(edges: DataFrame) -> DataFrame:
    """Node and edge count (one row), in one pass over the edge ends."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    return ends.agg(
        F.count_distinct("node").alias("n_nodes"),
        (F.count(F.lit(1)) / 2).cast("bigint").alias("n_edges"),
    )


def edge_widths(edges: DataFrame, exact: bool = True, as_written: bool = False) -> DataFrame:
    """Edges with a line width by amount quantile (0, .2, .4, .6, .8, 1).

    ``as_written`` gives the two classes the original branch order can reach: the
    smallest amount, and everything else.
    """
    compute = exact_quantiles if exact else approximate_quantiles
    cuts = compute(edges, "amount", (0.0, 0.2, 0.4, 0.6, 0.8, 1.0))
    row = cuts.first()  # six numbers, used as literals
    if row is None:
        return edges.withColumn("width", F.lit(None).cast("double"))
    cut = [F.lit(row[f"q{i}"]) for i in range(6)]
    if as_written:
        width = step_score(F.col("amount"), [cut[0], cut[5]], (*EDGE_WIDTHS[:2], WIDEST_EDGE))
    else:
        width = step_score(F.col("amount"), cut, (*EDGE_WIDTHS, WIDEST_EDGE))
    return edges.withColumn("width", width)


def _pointing(edges: DataFrame) -> DataFrame:
    """Edges as distinct (high, low) node pairs; a loop has the same node twice."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    """Every link as (u, v) and (v, u), in one pass over the links."""
    turned = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    return edges.select(turned.alias("link")).select("link.*")


def _link_metrics(width: int) -> list:
    """Aggregates of a round's links: their number, and the most frequent ends."""
    return [
        F.count(F.lit(1)).alias("links"),
        top_hashes("u", width).alias("top_u"),
        top_hashes("v", width).alias("top_v"),
    ]


def _hubs(seen: dict, width: int) -> dict[int, int]:
    """Salts of the nodes that hold more than a partition's share of the link ends."""
    counts: dict[int, int] = {}
    for item in [*(seen["top_u"] or []), *(seen["top_v"] or [])]:
        counts[item["item"]] = counts.get(item["item"], 0) + item["count"]
    return heavy_of(counts, 2 * seen["links"], width)


def _roots(links: DataFrame, hubs: dict[int, int]) -> DataFrame:
    """``node`` and ``root``, the smallest name at most two links away."""
    both = _both_ways(links)
    near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    # Each neighbour tells its smallest neighbour; a node is a neighbour of its neighbours.
    told = skew_safe_join(both, near, ["u"], heavy=hubs)
    return told.groupBy(F.col("v").alias("node")).agg(F.min("least").alias("root"))


def _contracted(links: DataFrame, roots: DataFrame, hubs: dict[int, int]) -> DataFrame:
    """Links between the roots, under new names; without loops and duplicates.

    The new name is a hash that no two whole numbers share, so the next round sees the
    nodes in another order.
    """
    for end in ("u", "v"):
        new_names = roots.select(F.col("node").alias(end), F.xxhash64("root").alias(f"{end}_root"))
        links = skew_safe_join(links, new_names, [end], heavy=hubs)
    return _pointing(
        links.filter("u_root <> v_root").select(F.col("u_root").alias("u"), F.col("v_root").alias("v"))
    )


def _unfolded(rounds: list[DataFrame]) -> DataFrame:
    """Every node of the first round with its class: ``level`` and ``name`` of the last root.

    Names of two rounds may be the same number, so the class is named by both.
    """
    labels = None
    for level, roots in reversed(list(enumerate(rounds))):
        named = roots.select("node", F.xxhash64("root").alias("next"))
        if labels is None:
            labels = named.select("node", F.lit(level).alias("level"), F.col("next").alias("name"))
            continue
        above = labels.withColumnsRenamed({"node": "next"})
        labels = skew_safe_join(named, above, ["next"], "left").select(
            "node", F.coalesce("level", F.lit(level)).alias("level"), F.coalesce("name", "next").alias("name")
        )
        if level:
            labels = reliable_checkpoint(labels)
    return labels


def _numbered(named: DataFrame, number: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Nodes with their ``id``, and the links between ids; ``number`` gives a node's id."""
    ends = named.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    links = named.filter("u <> v").select(number(F.col("u")).alias("u"), number(F.col("v")).alias("v"))
    return ends.withColumn("id", number(F.col("node"))), links


def _hashed(named: DataFrame, width: int, number: Callable[[Column], Column] = F.xxhash64) -> tuple[DataFrame, DataFrame]:
    """Nodes and links by a 64-bit hash of each node, which needs no join.

    If two nodes share a hash, the nodes are numbered instead and the numbers joined on.
    """
    nodes, links = _numbered(named, number)
    nodes, _, seen = measured_checkpoint(
        nodes, F.count(F.lit(1)).alias("nodes"), F.count_distinct("id").alias("ids")
    )
    if seen["nodes"] == seen["ids"]:
        return nodes, links
    nodes = reliable_checkpoint(nodes.withColumn("id", F.monotonically_increasing_id()))
    links = named.filter("u <> v")
    hubs = links.agg(*_link_metrics(width)).first().asDict(recursive=True)
    for end in ("u", "v"):
        numbers = nodes.select(F.col("node").alias(end), F.col("id").alias(f"{end}_id"))
        links = skew_safe_join(links, numbers, [end], heavy=_hubs(hubs, width))
    return nodes, reliable_checkpoint(links.select(F.col("u_id").alias("u"), F.col("v_id").alias("v")))


def connected_components(
    edges: DataFrame, max_rounds: int = 100, report: Callable[[int], None] | None = None
) -> DataFrame:
    """Weakly connected components: ``node`` and ``component`` (the smallest node of it).

    Contraction, after Bögeholz, Brand and Todor (2020): every node goes over to the node
    with the smallest random name at most two links away, links are renamed to these roots,
    and loops and duplicates dropped.  Every round leaves fewer links and, whatever the
    graph, a part of its nodes; a component without links left has its root and takes no
    part in later rounds.  Only the roots of each round are kept, and unfolded at the end.
    Joins on hub nodes are salted.  Nodes that are no whole numbers
    go by a hash, or by numbers where two share one.  ``report`` gets the number of links after each round.
    """
    spark, width = edges.sparkSession, shuffle_width(edges.sparkSession)
    named = reliable_checkpoint(
        _pointing(edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).dropna())
    )
    whole = all(isinstance(edges.schema[end].dataType, IntegralType) for end in ("src", "dst"))
    nodes, links = _numbered(named, lambda c: c.cast("bigint")) if whole else _hashed(named, width)
    seen, path = links.agg(*_link_metrics(width)).first().asDict(recursive=True), None
    rounds: list[DataFrame] = []
    while seen["links"]:
        if len(rounds) == max_rounds:
            raise RuntimeError(f"links left after {max_rounds} rounds")
        hubs = _hubs(seen, width)
        rounds.append(reliable_checkpoint(_roots(links, hubs)))
        links, new_path, seen = measured_checkpoint(
            _contracted(links, rounds[-1], hubs), *_link_metrics(width)
        )
        if path:
            remove_path(spark, path)
        path = new_path
        if report is not None:
            report(seen["links"])
    if not rounds:
        return nodes.select("node", F.col("node").alias("component"))
    classes = nodes.select("node", "id").join(_unfolded(rounds).withColumnRenamed("node", "id"), "id", "left")
    # A node without links to others is a class of its own; no round has the level -1.
    classes = classes.select(
        "node", F.coalesce("level", F.lit(-1)).alias("level"), F.coalesce("name", "id").alias("name")
    )
    smallest = classes.groupBy("level", "name").agg(F.min("node").alias("component"))
    return skew_safe_join(classes, smallest, ["level", "name"]).select("node", "component")


def component_edges(edges: DataFrame, components: DataFrame) -> DataFrame:
    """Edges of each component's induced subgraph (both ends lie in one component)."""
    labels = components.select(F.col("node").alias("src"), "component")
    return skew_safe_join(edges, labels, ["src"], "inner")


def component_totals(edges: DataFrame, components: DataFrame) -> DataFrame:
    """Nodes, edges and amount of every component."""
    nodes = components.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))
    per_source = edges.groupBy("src").agg(
        F.count(F.lit(1)).alias("n_edges"), F.sum("amount").alias("amount")
    )
    labels = components.select(F.col("node").alias("src"), "component")
    per_component = (
        per_source.join(labels, "src")
        .groupBy("component")
        .agg(F.sum("n_edges").alias("n_edges"), F.sum("amount").alias("amount"))
    )
    return nodes.join(per_component, "component", "left").select(
        "component",
        "n_nodes",
        F.coalesce("n_edges", F.lit(0)).alias("n_edges"),
        F.coalesce("amount", F.lit(0.0)).alias("amount"),
    )
