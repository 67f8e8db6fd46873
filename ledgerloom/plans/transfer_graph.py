"""Transfer graph: the cleaned links as a drawn graph, split into components."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from ledgerloom.operators.graph import (
    aggregate_edges,
    component_edges,
    component_totals,
    connected_components,
    edge_widths,
    node_roles,
)
from ledgerloom.session import reliable_checkpoint
from ledgerloom.sources.sinks import write_components


class TransferGraph(NamedTuple):
    """Nodes and edges with looks and component, and totals per component."""

    nodes: DataFrame
    edges: DataFrame
    components: DataFrame


def transfer_graph(
    transfers: DataFrame,
    sender: str = "id_sender",
    receiver: str = "id_receiver",
    amount: str = "amount_new",
) -> TransferGraph:
    """Edges by pair, node and edge looks, weakly connected components.

    The edges are checkpointed once: widths, components and totals all read them.
    """
    edges = reliable_checkpoint(aggregate_edges(transfers, sender, receiver, amount))
    components = connected_components(edges)
    nodes = node_roles(edges).join(components, "node")
    drawn = component_edges(edge_widths(edges), components)
    return TransferGraph(nodes, drawn, component_totals(edges, components))


def export_graph(graph: TransferGraph, path: str) -> None:
    """Every component in a folder of its own, shared by components of one hash."""
    write_components(graph.nodes, graph.edges, graph.components, path)
