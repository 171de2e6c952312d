import pytest
from pyspark.sql import functions as F

from cardlake.operators import graph, lookups, node_index
from cardlake.plans import heterograph
from cardlake.sources import readers
from tests.conftest import rows


def test_bipartite(frame):
    data = [(0, "c2", 9, 1), (1, "c1", 9, 0), (2, "c2", 7, 0), (3, "c2", 9, 0)]
    g = graph.build_bipartite(frame(data, "idx int, card_id string, merchant_name long, label int"))
    assert rows(g.nodes) == [(0, "card", "c2", 3), (1, "card", "c1", 1), (2, "merchant", "9", 3), (3, "merchant", "7", 1)]
    assert rows(g.edges.select("idx", "src", "dst", "label")) == [(0, 0, 2, 1), (1, 1, 2, 0), (2, 0, 3, 0), (3, 0, 2, 0)]


def test_unknown_nodes_count_as_node_0(frame):
    schema = "idx int, card_id string, merchant_name long"
    nodes = graph.bipartite_nodes(frame([(0, "c2", 9)], schema))
    found = graph.resolve_edges(frame([(1, "c2", 9), (2, "new", None)], schema), nodes, default=0)
    assert rows(found.select("idx", "src", "dst", "src_known", "dst_known")) == [
        (1, 0, 1, True, True), (2, 0, 0, False, False)]
    assert graph.resolve_edges(frame([(2, "new", 9)], schema), nodes).count() == 0


def write(path, text):
    path.write_text(text)
    return str(path)


def test_relation_golden(spark, tmp_path):
    relation = readers.read_edgelist(spark, write(tmp_path / "r.csv", "TransactionID,card\nt1,c1\nt2,c1\nt3,c2\n"))
    nodes = graph.index_nodes([relation])
    assert rows(nodes.select("type", "node_id", "key")) == [
        ("TransactionID", 0, "t1"), ("TransactionID", 1, "t2"), ("TransactionID", 2, "t3"), ("card", 0, "c1"), ("card", 1, "c2")]
    edges = graph.hetero_edges([relation], nodes, "TransactionID")
    assert rows(graph.graph_summary(edges)) == [
        ("card", "card<>target", "target", 3), ("target", "self_relation", "target", 3), ("target", "target<>card", "card", 3)]
    forward = edges.where("dst_type = 'card'").select("src", "dst")
    assert rows(forward) == [(0, 0), (1, 0), (2, 1)]

    features = readers.read_node_features(spark, write(tmp_path / "f.csv", "t1,1.5,true\nt9,2,False\nt2,3,TRUE\nt3,x,1\n"))
    every, found = graph.attach_features(nodes, features, "TransactionID")
    assert [(r["node_id"], r["key"], r["features"], r["is_new"]) for r in found.orderBy("node_id").collect()] == [
        (0, "t1", [1.5, 1.0], False), (1, "t2", [3.0, 1.0], False), (2, "t3", [None, 1.0], False),
        (3, "t9", [2.0, 0.0], True)]
    loops = graph.hetero_edges([relation], every, "TransactionID").where("relation = 'self_relation'")
    assert loops.count() == 4

    masked = readers.read_masked_nodes(spark, write(tmp_path / "m.txt", " t2 \n"))
    target = nodes.where("type = 'TransactionID'")
    masks = graph.node_masks(target, masked).orderBy("node_id").collect()
    assert [r["train_mask"] for r in masks] == [1, 0, 1] and [r["test_mask"] for r in masks] == [0, 1, 0]
    with pytest.raises(ValueError, match="t7"):
        graph.node_masks(target, spark.createDataFrame([("t7",)], "key string"))

    labels = readers.read_labels(spark, write(tmp_path / "l.csv", "TransactionID,isFraud\nt1,0\nt2,1\nt3,0\n"), "TransactionID")
    assert rows(graph.attach_labels(target, labels, 2)) == [(0, "t1", 0), (1, "t2", 1)]
    with pytest.raises(Exception, match="no label for node t9"):
        graph.attach_labels(every.where("type = 'TransactionID'"), labels).collect()
    kept = graph.attach_labels(every.where("type = 'TransactionID'"), labels, missing="null")
    assert rows(kept)[-1] == (3, "t9", None)


def test_shared_counter_and_later_relations(spark, frame):
    def relation(a, b, pairs):
        return graph.Relation(a, b, frame([(i, *p) for i, p in enumerate(pairs)], "row long, src string, dst string"))
    relations = [relation("user", "user", [("x", "y"), ("y", "z"), ("x", "x")]),
                 relation("target0", "user", [("t", "z"), ("u", "w")]),
                 relation("target0", "user", [("u", "x")]), relation("target0", "target0", [("t", "v")])]
    nodes = graph.index_nodes(relations)
    assert rows(nodes.select("type", "node_id", "key")) == [
        ("target0", 0, "t"), ("target0", 1, "u"), ("target0", 2, "v"),
        ("user", 0, "x"), ("user", 1, "y"), ("user", 2, "z"), ("user", 3, "w")]
    edges = graph.hetero_edges(relations, nodes, "target0")
    # the later target-user relation counts; within one type the reverse list stays
    assert rows(edges.select("relation", "src", "dst")) == [
        ("self_relation", 0, 0), ("self_relation", 1, 1), ("self_relation", 2, 2), ("target<>user", 1, 0),
        ("user<>target", 0, 1), ("user<>user", 0, 0), ("user<>user", 1, 0), ("user<>user", 2, 1)]


def test_edge_list_without_header(spark, tmp_path):
    path = write(tmp_path / "e.csv", "a,b\nb,c\n")
    relation = readers.read_edgelist(spark, path, header=False)
    assert (relation.src_type, relation.dst_type) == ("user", "user")
    assert rows(relation.rows) == [(0, "a", "b"), (1, "b", "c")]
    assert rows(readers.read_edgelist(spark, path, header=False, skip_first=True).rows) == [(1, "b", "c")]


def test_index_edges(frame):
    edges = frame([(0, "b", "a"), (1, "a", "c")], "row long, src string, dst string")
    assert rows(graph.index_edges(edges).edges) == [(0, 1, 0), (1, 2, 1)]
    listed = frame([(0, "a"), (1, "b"), (2, "a"), (3, "c")], "row long, key string")
    assert rows(graph.index_edges(edges, listed).edges) == [(0, 2, 1), (1, 0, 0)]
    with pytest.raises(Exception, match="unknown node c"):
        graph.index_edges(edges, listed.where("key <> 'c'")).edges.collect()


def test_additional_masks(frame):
    nodes = frame([(i, "t", f"k{i}") for i in range(100)], "node_id long, type string, key string")
    masked = frame([(f"k{i}",) for i in range(0, 100, 4)], "key string")
    out = graph.node_masks(nodes, masked, additional_rate=0.3)
    assert out.where("test_mask = 1").count() == 25 and out.where("train_mask = 1").count() == 45
    assert out.where("test_mask = 1 AND train_mask = 1").count() == 0
    assert graph.node_masks(nodes, masked, additional_rate=1.0).where("train_mask = 1").count() == 75


def test_select_relations():
    names = ["relation_a.csv", "tags.csv", "xrelation.csv"]
    assert graph.select_relations("relation*", names) == ["relation_a.csv"]
    assert graph.select_relations("a.csv,b.csv", names) == ["a.csv", "b.csv"]


def test_isolated_edges_keep_duplicates(frame):
    edges = frame([(i, "a", "b") for i in range(50)], "row long, src string, dst string")
    assert graph.index_edges(edges).edges.where(F.col("src_id") == 0).count() == 50


def test_features_without_broadcast(frame, monkeypatch):
    """A third of the feature lines belong to one node."""
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    nodes = frame([(i, "t", f"k{i}", 1) for i in range(20)], "node_id long, type string, key string, degree long")
    lines = [(i, "k0" if i % 3 == 0 else f"k{i % 25}", [float(i)]) for i in range(300)]
    every, found = graph.attach_features(nodes, frame(lines, "row long, key string, features array<double>"), "t")
    ids = {r["key"]: r["node_id"] for r in every.collect()}
    assert [ids[f"k{i}"] for i in range(20)] == list(range(20)) and sorted(ids.values()) == list(range(25))
    first = {}
    for row, key, _ in lines:
        first.setdefault(key, row)
    late = sorted((k for k in first if int(k[1:]) >= 20), key=first.get)
    assert [ids[k] for k in late] == [20, 21, 22, 23, 24]
    assert rows(found.select("features", "node_id")) == sorted(([x], ids[k]) for _, k, (x,) in lines)


def test_empty_ids_keep_their_edges(spark, tmp_path):
    path = write(tmp_path / "r.csv", 'a,b\nx,\n,y\nz,w\n"q,\n1",w\n')
    relation = readers.read_edgelist(spark, path)
    assert rows(relation.rows) == [(0, "x", ""), (1, "", "y"), (2, "z", "w"), (3, "q,\n1", "w")]
    nodes = graph.index_nodes([relation])
    assert rows(graph.index_relation(relation, nodes)) == [(0, 0, 0), (1, 1, 1), (2, 2, 2), (3, 2, 3)]
    assert rows(nodes.where("key = ''").select("type", "node_id")) == [("a", 1), ("b", 0)]
    frame = spark.createDataFrame([(0, None, "k"), (1, "k", None)], "row long, src string, dst string")
    assert rows(graph.index_edges(frame).edges) == [(0, 1, 0), (1, 0, 1)]


def test_stored_index_is_extended_and_survives_a_broken_extension(spark, tmp_path):
    def relation(pairs):
        return graph.Relation("u", "v", spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "row long, src string, dst string"))
    path = str(tmp_path / "index")
    assert node_index.read_index(spark, path).count() == 0
    first = node_index.extend_index(spark, path, [relation([("a", "x"), ("b", "y"), ("a", None)])])
    assert rows(first.select("type", "node_id", "key")) == [("u", 0, "a"), ("u", 1, "b"), ("v", 0, "x"), ("v", 1, "y"), ("v", 2, "")]
    # an extension that wrote its nodes but not its marks does not count, and its number is used again
    spark.createDataFrame([(2, "u", "lost", 1)], "node_id long, type string, key string, degree long").write.parquet(f"{path}/nodes/version=1")
    assert rows(node_index.read_index(spark, path).select("type", "node_id", "key")) == rows(first.select("type", "node_id", "key"))
    again = node_index.extend_index(spark, path, [relation([("c", "y"), ("a", "z"), ("c", "z")])])
    assert rows(again.select("type", "node_id", "key")) == [
        ("u", 0, "a"), ("u", 1, "b"), ("u", 2, "c"), ("v", 0, "x"), ("v", 1, "y"), ("v", 2, ""), ("v", 3, "z")]
    assert rows(node_index.extend_index(spark, path, [relation([("c", "y")])])) == rows(again)


def test_folder_to_heterograph(spark, tmp_path):
    write(tmp_path / "relation_a.csv", "t,card\n1,c1\n2,\n")
    write(tmp_path / "relation_b.csv", "t,city\n2,x\n")
    write(tmp_path / "features.csv", "2,1.5,true\n9,2,false\n\n1,abc,1\n3,1,1,7\n")
    index = str(tmp_path / "index")
    built = heterograph.build(spark, str(tmp_path), "relation*", "t", "features.csv", index)
    assert rows(built.nodes.select("type", "node_id", "key")) == [
        ("card", 0, "c1"), ("card", 1, ""), ("city", 0, "x"), ("t", 0, "1"), ("t", 1, "2"), ("t", 2, "9")]
    assert rows(graph.graph_summary(built.edges)) == [
        ("card", "card<>target", "target", 2), ("city", "city<>target", "target", 1), ("target", "self_relation", "target", 3),
        ("target", "target<>card", "card", 2), ("target", "target<>city", "city", 1)]
    assert rows(built.features.select("node_id", "features", "is_new")) == [(1, [1.5, 1.0], False), (2, [2.0, 0.0], True)]
    assert rows(built.rejects) == [(3, "1,abc,1", ["not a number: abc"]), (4, "3,1,1,7", ["3 values instead of 2"])]
    assert node_index.read_index(spark, index).count() == 6
    with pytest.raises(ValueError, match="no file"):
        heterograph.build(spark, str(tmp_path), "none.*", "t")


def test_features_of_the_node_list(frame):
    listed = frame([(0, "a", [1.0]), (1, "b", []), (2, "a", [9.0]), (3, None, [2.0])], "row long, key string, features array<double>")
    g = graph.index_edges(frame([(0, "b", "a")], "row long, src string, dst string"), listed)
    assert rows(g.edges.select("src_id", "dst_id", "row")) == [(1, 0, 0)]
    assert rows(graph.listed_features(listed, g.nodes)) == [(0, [1.0]), (2, [2.0])]
