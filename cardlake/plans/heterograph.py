"""A graph of several relations, read from a folder of files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cardlake.operators import graph, node_index
from cardlake.session import stage
from cardlake.sources import readers


@dataclass(frozen=True)
class Heterograph:
    """``nodes(node_id, type, key, …)``, ``edges(src_type, relation, dst_type, src, dst)``, the targets' features, and the lines of
    the feature file that do not fit."""

    nodes: DataFrame
    edges: DataFrame
    features: DataFrame | None
    rejects: DataFrame | None


def build(spark: SparkSession, folder: str, relations: str, target: str, features: str | None = None,
          index: str | None = None) -> Heterograph:
    """The edge lists in ``folder`` that ``relations`` names (a comma list, or an expression for the start of the names), and the
    feature file of the target nodes.

    With ``index`` the ids come from the index stored there, which is extended; without it they start at 0. Nodes that only the
    feature file knows are target nodes too, and every target node has a loop.
    """
    names = graph.select_relations(relations, readers.list_files(spark, folder))
    if not names:
        raise ValueError(f"no file in {folder} matches {relations!r}")
    lists = [readers.read_edgelist(spark, f"{folder}/{name}") for name in names]
    nodes = node_index.extend_index(spark, index, lists) if index else graph.index_nodes(lists)
    given = rejects = None
    if features:
        lines = readers.enforce_node_features(spark, f"{folder}/{features}")
        rejects = lines.rejects
        nodes, given = graph.attach_features(nodes, lines.valid, target, index)
    nodes = stage(nodes, "graph-nodes")
    return Heterograph(nodes, graph.hetero_edges(lists, nodes, target), given, rejects)
