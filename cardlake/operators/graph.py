"""Graphs as node and edge tables: the card–merchant multigraph and graphs of several relations."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from cardlake.operators import lookups
from cardlake.operators.lookups import heavy_keys, hot_keys, lookup, row_bytes, table_bytes
from cardlake.operators.ordering import dense_index
from cardlake.operators.sampling import take_exactly
from cardlake.session import stage

TARGET = "target"
SELF_RELATION = "self_relation"


@dataclass(frozen=True)
class Graph:
    """``nodes(node_id, type, key, …)`` and ``edges(src, dst, …)``."""

    nodes: DataFrame
    edges: DataFrame


def bipartite_nodes(rows: DataFrame, card: str = "card_id", merchant: str = "merchant_name",
                    order: str = "idx") -> DataFrame:
    """Cards, then merchants, numbered from 0 as first seen (equal positions by key, as text).

    One pass over the rows finds the first position and the number of rows of every key.
    """
    ends = F.array(*[F.struct(F.lit(kind).alias("type"), F.col(column).cast("string").alias("key"))
                     for kind, column in (("card", card), ("merchant", merchant))])
    first = stage(rows.select(order, F.explode(ends).alias("e")).where(F.col("e.key").isNotNull())
                  .groupBy(F.col("e.type").alias("type"), F.col("e.key").alias("key"))
                  .agg(F.min(order).alias("first_seen"), F.count("*").alias("degree")), "first-seen")
    sizes, start, parts = type_sizes(first), 0, []
    for kind in ("card", "merchant"):
        n = sizes.get(kind, (0, 0))[0]
        numbered = dense_index(first.where(F.col("type") == kind), ["first_seen", "key"], "node_id", start, rows=n)
        parts.append(numbered.select("node_id", "type", "key", "degree"))
        start += n
    return stage(parts[0].unionByName(parts[1]), "nodes")


def type_sizes(nodes: DataFrame) -> dict[str, tuple[int, int]]:
    """Rows and bytes of each node type; a graph has few types."""
    sizes = nodes.groupBy("type").agg(F.count("*").alias("n"), F.sum(row_bytes(nodes)).alias("bytes")).collect()
    return {r["type"]: (r["n"], r["bytes"]) for r in sizes}


def _look_up_nodes(rows: DataFrame, nodes: DataFrame, sizes: dict[str, tuple[int, int]], ends: Sequence[tuple[str, str, str]],
                   how: str, spread: Sequence[str] | None, counted: bool = False) -> DataFrame:
    """For each (name, column, kind) add ``name``, the id of the node of type ``kind`` whose key stands in ``column``.

    ``counted`` tells that the nodes' degrees count just these rows, which then are not read for hot keys."""
    size = {name: sizes.get(kind, (0, 0))[1] for name, _, kind in ends}
    large = {name: F.col(column).cast("string") for name, column, _ in ends if size[name] > lookups.BROADCAST_BYTES}
    if counted:
        hot = {name: hot_keys(nodes.where(F.col("type") == kind), "key", "degree") for name, _, kind in ends if name in large}
    else:
        hot = heavy_keys(rows, large) if large else {}
    out = rows
    for name, column, kind in ends:
        key = f"__{name}_key"
        table = nodes.where(F.col("type") == kind).select(F.col("key").alias(key), F.col("node_id").alias(name))
        out = lookup(out.withColumn(key, F.col(column).cast("string")), table, key, how, size[name], hot.get(name, ()), spread).drop(key)
    return out


def resolve_edges(rows: DataFrame, nodes: DataFrame, card: str = "card_id", merchant: str = "merchant_name",
                  default: int | None = None, spread: Sequence[str] | None = None,
                  sizes: dict[str, tuple[int, int]] | None = None, counted: bool = False) -> DataFrame:
    """Add ``src`` and ``dst``, the node ids of card and merchant.

    Without ``default`` rows whose nodes are unknown are dropped. With it they get that id, and ``src_known`` /
    ``dst_known`` tell them from rows that really meet this node.
    ``sizes`` saves measuring the nodes (:func:`type_sizes`), ``counted`` a pass over the rows whose nodes these are.
    """
    out = _look_up_nodes(rows, nodes, sizes or type_sizes(nodes), [("src", card, "card"), ("dst", merchant, "merchant")],
                         "inner" if default is None else "left", spread or rows.columns, counted)
    if default is not None:
        out = out.withColumns({
            "src_known": F.col("src").isNotNull(), "dst_known": F.col("dst").isNotNull(),
            "src": F.coalesce("src", F.lit(default)), "dst": F.coalesce("dst", F.lit(default))})
    return out


def build_bipartite(rows: DataFrame, card: str = "card_id", merchant: str = "merchant_name",
                    order: str = "idx") -> Graph:
    """One edge per row of ``rows``, all its columns kept."""
    nodes = bipartite_nodes(rows, card, merchant, order)
    return Graph(nodes, resolve_edges(rows, nodes, card, merchant, counted=True))


def graph_summary(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src_type", "relation", "dst_type").agg(F.count("*").alias("n_edges"))


def node_summary(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("type").agg(F.count("*").alias("n_nodes"))


# --- graphs of several relations ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Relation:
    """An edge list ``rows(row, src, dst)`` between two node types; ``row`` is the position in its file."""

    src_type: str
    dst_type: str
    rows: DataFrame


def select_relations(expression: str, names: Sequence[str]) -> list[str]:
    """A comma list as given, else those of ``names`` that the expression matches at their start."""
    if "," in expression:
        return expression.split(",")
    return [n for n in names if re.match(expression, n)]


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _ends(relations: Sequence[Relation]) -> DataFrame:
    """Both ends of every edge as (type, key, pos); ``pos`` orders by relation, row, side. A missing id is the empty one."""
    parts = []
    for number, relation in enumerate(relations):
        base = F.lit(number).cast("long") * F.lit(1 << 50) + F.col("row").cast("long") * 2
        ends = F.array(
            F.struct(F.lit(relation.src_type).alias("type"), _key("src").alias("key"), base.alias("pos")),
            F.struct(F.lit(relation.dst_type).alias("type"), _key("dst").alias("key"), (base + 1).alias("pos")))
        parts.append(relation.rows.select(F.explode(ends).alias("e")).select("e.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _numbered(first: DataFrame, start: dict[str, int], name: str) -> DataFrame:
    """``first(type, key, pos, degree)`` numbered by ``pos`` within each type, from the type's first free id on."""
    parts = [dense_index(first.where(F.col("type") == t), ["pos"], "node_id", start.get(t, 0), rows=n)
             for t, (n, _) in sorted(type_sizes(first).items())]
    if not parts:
        return first.select(F.lit(0).cast("long").alias("node_id"), "type", "key", "degree")
    return stage(reduce(DataFrame.unionByName, parts).select("node_id", "type", "key", "degree"), name)


def _first_seen(relations: Sequence[Relation]) -> DataFrame:
    return stage(_ends(relations).groupBy("type", "key").agg(F.min("pos").alias("pos"), F.count("*").alias("degree")), "ends")


def index_nodes(relations: Sequence[Relation]) -> DataFrame:
    """Nodes of all relations, numbered from 0 within each type as first seen."""
    return _numbered(_first_seen(relations), {}, "typed-nodes")


def index_relation(relation: Relation, nodes: DataFrame,
                   sizes: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """``(src_id, dst_id, row)`` of one relation; rows with an unknown node are dropped."""
    rows = relation.rows.withColumns({end: _key(end) for end in ("src", "dst")})
    out = _look_up_nodes(rows, nodes, sizes or type_sizes(nodes),
                         [("src_id", "src", relation.src_type), ("dst_id", "dst", relation.dst_type)], "inner", rows.columns)
    return out.select("src_id", "dst_id", "row")


def _both_ways(src: str, dst: str, edges: DataFrame) -> DataFrame:
    """Forward and reverse edges. Within one type both share a name, and the reverse list is the one that stays."""
    def edge(a: str, b: str, x: str, y: str):
        return F.struct(F.lit(a).alias("src_type"), F.lit(f"{a}<>{b}").alias("relation"), F.lit(b).alias("dst_type"),
                        F.col(x).alias("src"), F.col(y).alias("dst"))
    back = edge(dst, src, "dst_id", "src_id")
    both = F.array(back) if src == dst else F.array(edge(src, dst, "src_id", "dst_id"), back)
    return edges.select(F.explode(both).alias("e")).select("e.*")


def hetero_edges(relations: Sequence[Relation], nodes: DataFrame, target: str) -> DataFrame:
    """Edges of all relations with the target type renamed ``target``.

    Relations between targets give way to a self relation with one loop per target node. Of two relations between the
    same types the later one counts.
    """
    def rename(t: str) -> str:
        return TARGET if t == target else t

    last: dict = {}
    for relation in relations:
        ends = rename(relation.src_type), rename(relation.dst_type)
        if ends != (TARGET, TARGET):
            last[frozenset(ends)] = (ends, relation)
    loops = nodes.where(F.col("type") == target).select(
        F.lit(TARGET).alias("src_type"), F.lit(SELF_RELATION).alias("relation"), F.lit(TARGET).alias("dst_type"),
        F.col("node_id").alias("src"), F.col("node_id").alias("dst"))
    out, sizes = loops, type_sizes(nodes)
    for (src, dst), relation in last.values():
        out = out.unionByName(_both_ways(src, dst, index_relation(relation, nodes, sizes)))
    return out


def attach_features(nodes: DataFrame, features: DataFrame, target: str, index: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Give ``features(row, key, features)`` node ids of type ``target``.

    Keys that are no node yet become nodes with the next free ids, as first seen; they are added to the stored ``index`` if one is
    named (see :mod:`cardlake.operators.node_index`). Returns all nodes and ``(node_id, key, features, is_new)``.
    """
    features = features.withColumn("key", _key("key"))
    known = nodes.where(F.col("type") == target)
    free = known.agg(F.max("node_id")).first()[0]
    lines = stage(features.groupBy("key").agg(F.min("row").alias("pos"), F.count("*").alias("degree")), "feature-keys")
    fresh = stage(lines.join(known.select("key"), "key", "left_anti").withColumn("type", F.lit(target)), "new-keys")
    fresh = _numbered(fresh, {target: 0 if free is None else free + 1}, "new-nodes")
    if index:
        from cardlake.operators.node_index import append_nodes
        append_nodes(nodes.sparkSession, index, fresh)
    every = nodes.unionByName(fresh)
    ids = known.select("key", "node_id", F.lit(False).alias("is_new")).unionByName(
        fresh.select("key", "node_id", F.lit(True).alias("is_new")))
    found = lookup(features, ids, "key", "inner", table_bytes(ids), partial(hot_keys, lines, "key", "degree"), ["row"])
    return every, found.select("node_id", "key", "features", "is_new")


def attach_labels(nodes: DataFrame, labels: DataFrame, n: int | None = None, missing: str = "error") -> DataFrame:
    """``(node_id, key, label)`` of the first ``n`` nodes; a node without a label is an error, or null on request."""
    first = nodes if n is None else nodes.where(F.col("node_id") < n)
    out = first.select("node_id", "key").join(labels.select("key", "label"), "key", "left")
    if missing == "error":
        absent = F.raise_error(F.concat(F.lit("no label for node "), F.col("key"))).cast(labels.schema["label"].dataType)
        out = out.withColumn("label", F.when(F.col("label").isNull(), absent).otherwise(F.col("label")))
    return out.select("node_id", "key", "label")


def node_masks(nodes: DataFrame, masked: DataFrame, additional_rate: float = 0.0, seed: int = 42,
               check: bool = True) -> DataFrame:
    """``(node_id, key, train_mask, test_mask)``: masked nodes are the test nodes, the others train.

    With ``0 < additional_rate < 1`` further ``int(rate * n)`` nodes leave the train part, chosen by hash order. With
    ``check`` a masked key that is no node is an error.
    """
    listed = masked.select("key").distinct()
    if check:
        unknown = listed.join(nodes.select("key"), "key", "left_anti").take(1)
        if unknown:
            raise ValueError(f"masked node {unknown[0][0]!r} is not in the graph")
    out = nodes.select("node_id", "key").join(listed.withColumn("listed", F.lit(True)), "key", "left")
    out = out.select("node_id", "key", F.col("listed").isNotNull().alias("listed"))
    held = F.col("listed")
    if 0 < additional_rate < 1:
        out = stage(out, "listed")
        extra = take_exactly(out.where(~F.col("listed")), int(additional_rate * out.count()), "node_id", seed)
        out = out.join(extra.select("node_id", F.lit(True).alias("extra")), "node_id", "left")
        held = held | F.coalesce(F.col("extra"), F.lit(False))
    return out.select("node_id", "key", (~held).cast("int").alias("train_mask"),
                      F.col("listed").cast("int").alias("test_mask"))


def index_edges(rows: DataFrame, nodes: DataFrame | None = None) -> Graph:
    """Edges ``(row, src, dst)`` of one node type as ids, numbered as first seen.

    Given ``nodes(row, key)``, ids follow that list and an edge with a node outside it is an error.
    """
    if nodes is None:
        relation = Relation("node", "node", rows)
        indexed = index_nodes([relation])
        return Graph(indexed, index_relation(relation, indexed))
    first = nodes.groupBy(_key("key").alias("key")).agg(
        F.min("row").alias("row"), F.count("*").alias("degree"))
    indexed = stage(dense_index(stage(first, "listed-keys"), ["row"], "node_id")
                    .select("node_id", F.lit("node").alias("type"), "key", "degree"), "listed-nodes")
    rows = rows.withColumns({end: _key(end) for end in ("src", "dst")})
    out = _look_up_nodes(rows, indexed, type_sizes(indexed), [("src_id", "src", "node"), ("dst_id", "dst", "node")], "left", rows.columns)
    for end in ("src", "dst"):
        unknown = F.raise_error(F.concat(F.lit("edge with unknown node "), F.col(end))).cast("long")
        out = out.withColumn(f"{end}_id", F.coalesce(F.col(f"{end}_id"), unknown))
    return Graph(indexed, out.select("src_id", "dst_id", "row"))


def listed_features(nodes: DataFrame, indexed: DataFrame) -> DataFrame:
    """``(node_id, features)`` of a list ``nodes(row, key, features)``: each node's first line, if it holds a number."""
    first = nodes.groupBy(_key("key").alias("key")).agg(F.min_by("features", "row").alias("features"))
    found = lookup(first, indexed.select("key", "node_id"), "key", "inner", table_bytes(indexed), ())
    return found.where(F.size("features") > 0).select("node_id", "features")
