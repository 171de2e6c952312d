"""Features, samples, graphs, attention, scores and metrics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake.operators import attention, features, graph, metrics, model, neural, node_index, ordering, report, sampling, training
from cardlake.operators.lookups import table_bytes
from cardlake.plans import heterograph
from cardlake.plans.registry import EDGE, TXN, query
from cardlake.session import let_go, scratch_path, shuffles_deleted, stage, staged_until_done
from cardlake.sources import adapters, readers, sinks


def _rounded(columns: dict[str, Column], digits: int = 6) -> list[Column]:
    return [F.round(c, digits).alias(n) for n, c in columns.items()]


# --- features ----------------------------------------------------------------------------------------------------

@query(f"""WITH {TXN}
SELECT idx, dense_rank() OVER (ORDER BY merchant_city) - 1 AS merchant_city,
  dense_rank() OVER (ORDER BY use_chip) - 1 AS use_chip, dense_rank() OVER (ORDER BY coalesce(errors, 'No error')) - 1 AS errors
FROM txn""")
def label_codes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.prepare(adapters.transactions(spark, sf_dir)).select("idx", *features.CODED)
    codes = features.fit_label_codes(rows, features.CODED)
    return features.apply_label_codes(rows, codes, spread=["idx"])


@query(f"""WITH {TXN}
SELECT idx, dense_rank() OVER (ORDER BY mcc) - 1 AS mcc, dense_rank() OVER (ORDER BY merchant_name) - 1 AS merchant_name
FROM txn""")
def label_codes_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir).select("idx", "mcc", "merchant_name")
    return features.apply_label_codes(rows, features.fit_label_codes(rows, ["mcc", "merchant_name"]), spread=["idx"])


@query(f"""WITH {TXN}, fit AS (SELECT merchant_city AS v, dense_rank() OVER (ORDER BY merchant_city) - 1 AS code
  FROM (SELECT DISTINCT merchant_city FROM txn WHERE is_fraud = 'Yes' AND merchant_city < 'city2'))
SELECT idx, coalesce(code, 0) AS merchant_city, CASE WHEN merchant_state IS NULL THEN 0 ELSE s.c END AS merchant_state
FROM txn LEFT JOIN fit ON v = merchant_city
LEFT JOIN (SELECT merchant_state AS m, dense_rank() OVER (ORDER BY merchant_state) - 1 AS c
  FROM (SELECT DISTINCT merchant_state FROM txn WHERE merchant_state IS NOT NULL)) s ON m = merchant_state""")
def label_codes_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes fitted on some rows and applied to all: unseen and missing values give 0."""
    txn = adapters.transactions(spark, sf_dir)
    seen = report.fraud_only(txn).where(F.col("merchant_city") < "city2")
    codes = {**features.fit_label_codes(seen, ["merchant_city"]), **features.fit_label_codes(txn, ["merchant_state"])}
    rows = txn.select("idx", "merchant_city", "merchant_state")
    return features.apply_label_codes(rows, codes, unseen="zero", falsy_zero=True, spread=["idx"])


_SCALED = """(amt - min(amt) OVER ()) / (max(amt) OVER () - min(amt) OVER ()) AS amount,
  CAST(("year" - min("year") OVER ()) AS DOUBLE) AS "year", CAST("month" - min("month") OVER () AS DOUBLE) AS "month",
  CAST("day" - min("day") OVER () AS DOUBLE) / (max("day") OVER () - min("day") OVER ()) AS "day" """
_AMOUNTS = f"""{TXN}, priced AS (SELECT *, CAST(replace(amount, '$', '') AS DOUBLE) AS amt FROM txn)"""


@query(f"""WITH {_AMOUNTS}, scaled AS (SELECT idx, {_SCALED} FROM priced)
SELECT idx, round(amount, 9) AS amount, "year", "month", round("day", 9) AS "day" FROM scaled""")
def minmax_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.prepare(adapters.transactions(spark, sf_dir)).select("idx", *features.SCALED)
    scaled = features.apply_minmax(rows, features.fit_minmax(rows, features.SCALED))
    return scaled.withColumns({"amount": F.round("amount", 9), "day": F.round("day", 9)})


@query(f"""WITH {_AMOUNTS}, scaled AS (SELECT idx, "user" || '_' || card AS card_id, {_SCALED},
  dense_rank() OVER (ORDER BY merchant_city) - 1 AS city, dense_rank() OVER (ORDER BY use_chip) - 1 AS chip,
  dense_rank() OVER (ORDER BY coalesce(errors, 'No error')) - 1 AS err FROM priced)
SELECT idx, card_id, round(amount, 9) AS a0, CAST(city AS DOUBLE) AS a1, CAST(chip AS DOUBLE) AS a2, "year" AS a3,
  "month" AS a4, round("day", 9) AS a5, CAST(err AS DOUBLE) AS a6 FROM scaled""")
def edge_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.prepare(adapters.transactions(spark, sf_dir))
    coded = features.apply_label_codes(rows, features.fit_label_codes(rows, features.CODED), spread=["idx"])
    scaled = features.apply_minmax(coded, features.fit_minmax(rows, features.SCALED))
    shaped = scaled.select("idx", "card_id", features.edge_attr().alias("v"))
    return shaped.select("idx", "card_id", *_rounded({f"a{i}": F.get("v", F.lit(i)) for i in range(7)}, 9))


# --- samples and splits ------------------------------------------------------------------------------------------

@query(f"""WITH {TXN}, keyed AS (SELECT idx, is_fraud, md5('42:' || idx) AS shuffle_key FROM txn)
SELECT * FROM keyed WHERE is_fraud = 'Yes'
UNION ALL (SELECT * FROM keyed WHERE is_fraud = 'No' ORDER BY shuffle_key LIMIT 500)""")
def rebalance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.transactions(spark, sf_dir).select("idx", "is_fraud")
    return sampling.rebalance(rows, 500)


@query(f"""WITH {TXN}, keyed AS (
  SELECT idx, is_fraud, row_number() OVER (PARTITION BY is_fraud ORDER BY md5('42:' || idx)) AS r FROM txn),
sizes AS (SELECT is_fraud, count(*) AS n, sum(count(*)) OVER () AS total FROM txn GROUP BY 1),
shared AS (SELECT *, total - CAST(ceil(0.2 * total) AS BIGINT) AS n_train FROM sizes),
floors AS (SELECT *, n * n_train // total AS base, n * n_train % total AS rest FROM shared),
quotas AS (SELECT is_fraud, n - base - CASE WHEN row_number() OVER (ORDER BY rest DESC, is_fraud)
  <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS n_test FROM floors)
SELECT idx, is_fraud, CASE WHEN r <= n_test THEN 'test' ELSE 'train' END AS split FROM keyed JOIN quotas USING (is_fraud)""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_split(adapters.transactions(spark, sf_dir).select("idx", "is_fraud"), "is_fraud")


@query("""SELECT o_orderkey, o_orderstatus,
  CASE WHEN substr(md5('42:' || o_orderkey), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split FROM orders""")
def threshold_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_split(rows, "o_orderstatus", "o_orderkey", mode="threshold")


# --- the card-merchant graph -------------------------------------------------------------------------------------

_NODES = f"""{EDGE}, cards AS (
  SELECT row_number() OVER (ORDER BY min(l_orderkey), card_id) - 1 AS node_id, 'card' AS type, card_id AS key,
    count(*) AS degree FROM edge GROUP BY card_id),
merchants AS (
  SELECT row_number() OVER (ORDER BY min(l_orderkey), CAST(merchant AS VARCHAR)) - 1 + (SELECT count(*) FROM cards) AS node_id,
    'merchant' AS type, CAST(merchant AS VARCHAR) AS key, count(*) AS degree FROM edge GROUP BY merchant),
nodes AS (SELECT * FROM cards UNION ALL SELECT * FROM merchants),
resolved AS (
  SELECT c.node_id AS src, m.node_id AS dst, edge.* FROM edge JOIN cards c ON c.key = card_id
  JOIN merchants m ON m.key = CAST(merchant AS VARCHAR))"""


def _payments(spark: SparkSession, sf_dir: str) -> graph.Graph:
    return graph.build_bipartite(adapters.labelled_edges(spark, sf_dir), "card_id", "merchant", "l_orderkey")


@query(f"WITH {_NODES} SELECT node_id, type, key, degree FROM nodes")
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.bipartite_nodes(adapters.labelled_edges(spark, sf_dir), "card_id", "merchant", "l_orderkey")


@query(f"""WITH {_NODES} SELECT src, dst, label, amount, "year", "month", "day" FROM resolved""")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payments(spark, sf_dir).edges.select("src", "dst", "label", "amount", "year", "month", "day")


@query(f"""WITH {TXN}, seen AS (SELECT * FROM txn WHERE is_fraud = 'Yes' AND amount < '$3'),
cards AS (SELECT "user" || '_' || card AS k, row_number() OVER (ORDER BY min(idx)) - 1 AS id FROM seen GROUP BY 1),
merchants AS (SELECT merchant_name AS k, row_number() OVER (ORDER BY min(idx)) - 1 + (SELECT count(*) FROM cards) AS id
  FROM seen GROUP BY 1)
SELECT idx, coalesce(c.id, 0) AS src, coalesce(m.id, 0) AS dst, CAST(c.id IS NOT NULL AS INT) AS src_known,
  CAST(m.id IS NOT NULL AS INT) AS dst_known
FROM txn LEFT JOIN cards c ON c.k = "user" || '_' || card LEFT JOIN merchants m ON m.k = merchant_name""")
def node_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = adapters.transactions(spark, sf_dir)
    nodes = graph.bipartite_nodes(features.prepare(report.fraud_only(txn).where(F.col("amount") < "$3")))
    found = graph.resolve_edges(features.prepare(txn), nodes, default=0, spread=["idx"])
    return found.select("idx", "src", "dst", F.col("src_known").cast("int").alias("src_known"),
                        F.col("dst_known").cast("int").alias("dst_known"))


# --- graphs of several relations ---------------------------------------------------------------------------------

def _relations(spark: SparkSession, sf_dir: str) -> list[graph.Relation]:
    """order–customer, customer–order status, order–order (equal keys) and customer–supplier nation."""
    orders = adapters.table(spark, sf_dir, "orders")
    customers = adapters.table(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    return [
        graph.Relation("order", "customer", orders.select(
            key.alias("row"), key.cast("string").alias("src"), F.col("o_custkey").cast("string").alias("dst"))),
        graph.Relation("order", "priority", orders.select(
            key.alias("row"), key.cast("string").alias("src"), F.col("o_orderpriority").alias("dst"))),
        graph.Relation("order", "order", orders.select(
            key.alias("row"), key.cast("string").alias("src"), F.concat(F.lit("r"), key.cast("string")).alias("dst"))),
        graph.Relation("customer", "customer", customers.select(
            F.col("c_custkey").alias("row"), F.col("c_custkey").cast("string").alias("src"),
            F.col("c_nationkey").cast("string").alias("dst")))]


_RELATIONS = """
rel AS (
  SELECT 0 AS no, o_orderkey AS r, 'order' AS st, 'customer' AS dt, CAST(o_orderkey AS VARCHAR) AS s,
    CAST(o_custkey AS VARCHAR) AS d FROM orders
  UNION ALL SELECT 1, o_orderkey, 'order', 'priority', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders
  UNION ALL SELECT 2, o_orderkey, 'order', 'order', CAST(o_orderkey AS VARCHAR), 'r' || o_orderkey FROM orders
  UNION ALL SELECT 3, c_custkey, 'customer', 'customer', CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR)
    FROM customer),
ends AS (SELECT no, r, 0 AS side, st AS type, s AS key FROM rel UNION ALL SELECT no, r, 1, dt, d FROM rel),
firsts AS (SELECT type, key, count(*) AS degree, min(no * 100000000000 + r * 2 + side) AS pos FROM ends GROUP BY 1, 2),
nodes AS (SELECT row_number() OVER (PARTITION BY type ORDER BY pos) - 1 AS node_id, type, key, degree FROM firsts),
pairs AS (SELECT no, r, st, dt, a.node_id AS src, b.node_id AS dst FROM rel
  JOIN nodes a ON a.type = st AND a.key = s JOIN nodes b ON b.type = dt AND b.key = d),
named AS (SELECT CASE st WHEN 'order' THEN 'target' ELSE st END AS st, CASE dt WHEN 'order' THEN 'target' ELSE dt END AS dt,
  src, dst FROM pairs),
hetero AS (
  SELECT st AS src_type, st || '<>' || dt AS relation, dt AS dst_type, src, dst FROM named WHERE st <> dt
  UNION ALL SELECT dt, dt || '<>' || st, st, dst, src FROM named WHERE NOT (st = 'target' AND dt = 'target')
  UNION ALL SELECT 'target', 'self_relation', 'target', node_id, node_id FROM nodes WHERE type = 'order')"""


@query(f"WITH {_RELATIONS} SELECT node_id, type, key, degree FROM nodes")
def hetero_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.index_nodes(_relations(spark, sf_dir))


@query(f"WITH {_RELATIONS} SELECT * FROM hetero")
def hetero_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    relations = _relations(spark, sf_dir)
    return graph.hetero_edges(relations, graph.index_nodes(relations), "order")


@query(f"WITH {_RELATIONS} SELECT src_type, relation, dst_type, count(*) AS n_edges FROM hetero GROUP BY 1, 2, 3")
def graph_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    relations = _relations(spark, sf_dir)
    return graph.graph_summary(graph.hetero_edges(relations, graph.index_nodes(relations), "order"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order as nodes of one type, numbered by their order keys."""
    orders = adapters.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row"), F.col("o_orderkey").cast("string").alias("dst"),
        F.col("o_custkey").cast("string").alias("src"))
    nodes = graph.index_nodes([graph.Relation("customer", "order", orders)])
    return nodes.where(F.col("type") == "customer")


_CUSTOMERS = """nodes AS (SELECT row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS node_id,
  CAST(o_custkey AS VARCHAR) AS key FROM orders GROUP BY o_custkey)"""


@query(f"""WITH {_CUSTOMERS}, listed AS (SELECT node_id, key, key IN (
    SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING') AS masked FROM nodes),
ranked AS (SELECT *, row_number() OVER (PARTITION BY masked ORDER BY md5('42:' || node_id)) AS r FROM listed)
SELECT node_id, key, CASE WHEN masked OR r <= CAST(floor(0.1 * (SELECT count(*) FROM nodes)) AS BIGINT) THEN 0 ELSE 1 END
  AS train_mask, CASE WHEN masked THEN 1 ELSE 0 END AS test_mask FROM ranked""")
def node_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _customers(spark, sf_dir)
    masked = (adapters.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
              .select(F.col("c_custkey").cast("string").alias("key")).join(nodes.select("key"), "key", "left_semi"))
    return graph.node_masks(nodes, masked, additional_rate=0.1)


@query(f"""WITH {_CUSTOMERS}, known AS (
  SELECT CAST(c_custkey AS VARCHAR) AS key, c_custkey AS row, c_acctbal AS f0,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END AS f1 FROM customer
  UNION ALL SELECT 's' || s_suppkey, 1000000000 + s_suppkey, s_acctbal, 0.0 FROM supplier),
ids AS (SELECT key, node_id, 0 AS is_new FROM nodes UNION ALL
  SELECT key, row_number() OVER (ORDER BY row) - 1 + (SELECT count(*) FROM nodes), 1 FROM known
  WHERE key NOT IN (SELECT key FROM nodes))
SELECT node_id, key, is_new, f0, CAST(f1 AS DOUBLE) AS f1 FROM known JOIN ids USING (key)""")
def node_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = adapters.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("row"), F.col("c_custkey").cast("string").alias("key"),
        F.array("c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", 1.0).otherwise(0.0)).alias("features"))
    suppliers = adapters.table(spark, sf_dir, "supplier").select(
        (F.lit(1_000_000_000) + F.col("s_suppkey")).alias("row"),
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("key"),
        F.array("s_acctbal", F.lit(0.0)).alias("features"))
    _, found = graph.attach_features(_customers(spark, sf_dir), customers.unionByName(suppliers), "customer")
    return found.select("node_id", "key", F.col("is_new").cast("int").alias("is_new"),
                        F.get("features", F.lit(0)).alias("f0"), F.get("features", F.lit(1)).alias("f1"))


@query(f"""WITH {_CUSTOMERS} SELECT node_id, key, c_nationkey AS label FROM nodes JOIN customer
  ON key = CAST(c_custkey AS VARCHAR)""")
def node_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = adapters.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.col("c_nationkey").alias("label"))
    return graph.attach_labels(_customers(spark, sf_dir), labels)


_ONE_TYPE = """ends AS (SELECT o_orderkey * 2 AS pos, CAST(o_custkey AS VARCHAR) AS key FROM orders
  UNION ALL SELECT o_orderkey * 2 + 1, CAST(o_orderkey AS VARCHAR) FROM orders),
nodes AS (SELECT key, row_number() OVER (ORDER BY min(pos)) - 1 AS id FROM ends GROUP BY key)"""


@query(f"""WITH {_ONE_TYPE}
SELECT o_orderkey AS row, a.id AS src_id, b.id AS dst_id FROM orders JOIN nodes a ON a.key = CAST(o_custkey AS VARCHAR)
JOIN nodes b ON b.key = CAST(o_orderkey AS VARCHAR)""")
def homogeneous_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row"), F.col("o_custkey").cast("string").alias("src"),
        F.col("o_orderkey").cast("string").alias("dst"))
    return graph.index_edges(rows).edges


@query("""WITH lines AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row, o_orderkey, o_custkey FROM orders),
customers AS (SELECT o_custkey, row_number() OVER (ORDER BY min(row)) - 1 AS id FROM lines GROUP BY 1)
SELECT row, row AS src_id, id AS dst_id, 'order<>customer' AS relation FROM lines JOIN customers USING (o_custkey)""")
def relation_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An edge list file with a header that names the types, picked by name, read and indexed."""
    root = scratch_path(spark, "relations")
    edges = adapters.table(spark, sf_dir, "orders").orderBy("o_orderkey").select(
        F.col("o_orderkey").alias("order"), F.col("o_custkey").alias("customer"))
    edges.write.option("header", True).csv(f"{root}/relation_order_customer")
    name, = graph.select_relations("relation*", ["relation_order_customer", "labels"])
    relation = readers.read_edgelist(spark, f"{root}/{name}")
    indexed = graph.index_relation(relation, graph.index_nodes([relation]))
    return indexed.withColumn("relation", F.lit(f"{relation.src_type}<>{relation.dst_type}"))


def _folder_sql(some: str) -> str:
    """The relation files' rows and the ids of their customers and statuses."""
    return f"""a AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row, CAST(o_orderkey AS VARCHAR) AS o, CAST(o_custkey AS VARCHAR) AS c,
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE o_orderstatus END AS s FROM orders WHERE {some}),
customers AS (SELECT c AS key, row_number() OVER (ORDER BY min(row)) - 1 AS node_id FROM a GROUP BY c),
statuses AS (SELECT s AS key, row_number() OVER (ORDER BY min(row)) - 1 AS node_id FROM a GROUP BY s)"""


def _write_relations(orders: DataFrame, root: str) -> None:
    """Two relation files about the orders (a status may be empty), in the order of the order keys."""
    status = F.when(F.pmod("o_orderkey", F.lit(10)) == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    for name, column in (("customer", F.col("o_custkey")), ("status", status)):
        sinks.write_csv(orders.orderBy("o_orderkey").select(F.col("o_orderkey").alias("order"), column.alias(name)), f"{root}/relation_{name}")


@query(f"""WITH {_folder_sql("o_orderkey % 3 <> 0")},
later AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row, CAST(o_orderkey AS VARCHAR) AS o, CAST(o_custkey AS VARCHAR) AS c
  FROM orders WHERE o_orderkey % 3 = 0)
SELECT 'order' AS type, o AS key, row AS node_id FROM a
UNION ALL SELECT 'order', o, row + (SELECT count(*) FROM a) FROM later
UNION ALL SELECT 'customer', key, node_id FROM customers
UNION ALL SELECT 'customer', c, row_number() OVER (ORDER BY min(row)) - 1 + (SELECT count(*) FROM customers) FROM later
  WHERE c NOT IN (SELECT key FROM customers) GROUP BY c
UNION ALL SELECT 'status', key, node_id FROM statuses""")
def node_index_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders: two relation files about two thirds of them give ids that a third file, read later, only adds to."""
    root, orders = scratch_path(spark, "relations"), adapters.table(spark, sf_dir, "orders")
    _write_relations(orders.where("o_orderkey % 3 <> 0"), f"{root}/files")
    heterograph.build(spark, f"{root}/files", "relation.*", "order", index=f"{root}/index")
    later = orders.where("o_orderkey % 3 = 0").orderBy("o_orderkey")
    sinks.write_csv(later.select(F.col("o_orderkey").alias("order"), F.col("o_custkey").alias("customer")), f"{root}/files/late_customer")
    heterograph.build(spark, f"{root}/files", "late.*", "order", index=f"{root}/index")
    return node_index.read_index(spark, f"{root}/index").select("type", "key", "node_id")


@query(f"""WITH {_folder_sql("true")}, pairs AS (
  SELECT 'customer' AS other, row AS src, node_id AS dst FROM a JOIN customers ON c = key
  UNION ALL SELECT 'status', row, node_id FROM a JOIN statuses ON s = key)
SELECT 'target' AS src_type, 'target<>' || other AS relation, other AS dst_type, src, dst FROM pairs
UNION ALL SELECT other, other || '<>target', 'target', dst, src FROM pairs
UNION ALL SELECT 'target', 'self_relation', 'target', row, row FROM a""")
def heterograph_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph of all relation files in a folder; edges to the empty status count."""
    root = scratch_path(spark, "relations")
    _write_relations(adapters.table(spark, sf_dir, "orders"), root)
    return heterograph.build(spark, root, "relation.*", "order").edges


@query(f"""WITH {_folder_sql("true")} SELECT row AS src_id, node_id + (SELECT count(*) FROM a) AS dst_id FROM a JOIN statuses ON s = key""")
def listed_nodes_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between nodes of a given list, which numbers them: orders first, then the statuses."""
    orders = ordering.dense_index(adapters.table(spark, sf_dir, "orders"), ["o_orderkey"], "row")
    status = F.when(F.pmod("o_orderkey", F.lit(10)) == 0, F.lit("")).otherwise(F.col("o_orderstatus"))
    edges = orders.select("row", F.col("o_orderkey").cast("string").alias("src"), F.concat(F.lit("s"), status).alias("dst"))
    after = edges.select((F.col("row") + edges.count()).alias("row"), F.col("dst").alias("key"))
    listed = edges.select("row", F.col("src").alias("key")).unionByName(after)
    return graph.index_edges(edges, listed).edges.select("src_id", "dst_id")


# --- attention and perceptrons -----------------------------------------------------------------------------------

_ATT_SRC, _ATT_DST = [[0.7, -0.4], [1.5, 0.3]], [[-0.2, 0.9], [0.5, -1.1]]


def _vector(width: int) -> Column:
    """Stand-in weights that only depend on the node id."""
    return F.array(*[F.pmod(F.col("node_id") * (i + 3), F.lit(17)) / F.lit(17.0) - F.lit(0.5) for i in range(width)])


_H = ", ".join(f"(node_id * {i + 3} % 17) / 17.0 - 0.5 AS h{i}" for i in range(4))
_LOGITS = ", ".join(
    f"{_ATT_SRC[k][0]} * a.h{2 * k} + {_ATT_SRC[k][1]} * a.h{2 * k + 1} + {_ATT_DST[k][0]} * b.h{2 * k} "
    f"+ {_ATT_DST[k][1]} * b.h{2 * k + 1} AS e{k}" for k in range(2))


@query(f"""WITH {_NODES}, vec AS (SELECT CAST(node_id AS BIGINT) AS node_id, {_H} FROM
  (SELECT CAST(node_id AS DOUBLE) AS node_id FROM nodes)),
msg AS (SELECT src, dst FROM resolved UNION ALL SELECT node_id, node_id FROM nodes),
raw AS (SELECT src, dst, a.h0, a.h1, a.h2, a.h3, {_LOGITS} FROM msg JOIN vec a ON a.node_id = src JOIN vec b ON b.node_id = dst),
act AS (SELECT * REPLACE (CASE WHEN e0 > 0 THEN e0 ELSE 0.2 * e0 END AS e0, CASE WHEN e1 > 0 THEN e1 ELSE 0.2 * e1 END AS e1)
  FROM raw),
top AS (SELECT *, exp(e0 - max(e0) OVER (PARTITION BY dst)) AS w0, exp(e1 - max(e1) OVER (PARTITION BY dst)) AS w1 FROM act)
SELECT dst AS node_id, round(sum(w0 * h0) / sum(w0), 6) + 0.0 AS z0, round(sum(w0 * h1) / sum(w0), 6) + 0.0 AS z1,
  round(sum(w1 * h2) / sum(w1), 6) + 0.0 AS z2, round(sum(w1 * h3) / sum(w1), 6) + 0.0 AS z3 FROM top GROUP BY dst""")
def attention_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _payments(spark, sf_dir)
    z = attention.attention_layer(g.nodes.select("node_id", _vector(4).alias("h")), g.edges, _ATT_SRC, _ATT_DST)
    return z.select("node_id", *_rounded({f"z{i}": F.get("z", F.lit(i)) for i in range(4)}))


@query(f"""WITH {_NODES}, vec AS (SELECT CAST(node_id AS BIGINT) AS node_id, {_H} FROM
  (SELECT CAST(node_id AS DOUBLE) AS node_id FROM nodes))
SELECT src, dst, round(a.h0, 6) + 0.0 AS r0, round(a.h1, 6) + 0.0 AS r1, round(b.h0, 6) + 0.0 AS r2,
  round(b.h1, 6) + 0.0 AS r3, l_discount AS r4, l_tax AS r5, round(abs(a.h0 - b.h0), 6) AS r6, round(abs(a.h1 - b.h1), 6) AS r7
FROM resolved JOIN vec a ON a.node_id = src JOIN vec b ON b.node_id = dst""")
def edge_representation(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _payments(spark, sf_dir)
    edges = g.edges.select("src", "dst", F.array("l_discount", "l_tax").alias("edge_vec"))
    full = attention.edge_representation(edges, g.nodes.select("node_id", _vector(2).alias("z")))
    return full.select("src", "dst", *_rounded({f"r{i}": F.get("edge_repr", F.lit(i)) for i in range(8)}))


# Fixed weights of a small perceptron, 4 → 3 → 2.
_W1 = [[0.5, -1.0, 0.25], [2.0, 0.5, -3.0], [-1.5, 4.0, 1.0], [0.75, -0.5, 1.25]]
_B1 = [0.1, -0.2, 0.3]
_W2 = [[1.0, -0.5], [-0.75, 0.5], [0.25, 1.5]]
_B2 = [0.05, -0.15]
_INPUTS = ["amount / 100000.0", "l_discount", "l_tax", "l_quantity / 50.0"]


def _unit(j: int) -> str:
    return "greatest(0.0, " + " + ".join(f"{_W1[i][j]} * ({x})" for i, x in enumerate(_INPUTS)) + f" + {_B1[j]})"


_MLP = f"""{EDGE}, hidden AS (SELECT *, {', '.join(f'{_unit(j)} AS u{j}' for j in range(3))} FROM edge),
scored AS (SELECT *, {', '.join(' + '.join(f'{_W2[j][k]} * u{j}' for j in range(3)) + f' + {_B2[k]} AS l{k}' for k in range(2))}
  FROM hidden)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.labelled_edges(spark, sf_dir)
    x = F.array(F.col("amount") / 100000.0, "l_discount", "l_tax", F.col("l_quantity") / 50.0)
    weights = [(np.array(_W1), np.array(_B1)), (np.array(_W2), np.array(_B2))]
    return neural.predict_columns(rows.withColumn("logits", neural.dense_layers(x, weights)))


@query(f"""WITH {_MLP} SELECT l_orderkey, l_partkey, l_linenumber, round(l0, 12) + 0.0 AS logit0, round(l1, 12) + 0.0 AS logit1
FROM scored""")
def mlp_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("l_orderkey", "l_partkey", "l_linenumber", *_rounded(
        {"logit0": F.col("logit0"), "logit1": F.col("logit1")}, 12))


@query(f"""WITH {_MLP} SELECT l_orderkey, l_partkey, l_linenumber, round(exp(l1) / (exp(l0) + exp(l1)), 6) AS confidence,
  CASE WHEN l1 > l0 THEN 1 ELSE 0 END AS pred, CASE WHEN l1 > l0 THEN 'Yes' ELSE 'No' END AS prediction FROM scored""")
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("l_orderkey", "l_partkey", "l_linenumber",
                                         F.round("confidence", 6).alias("confidence"), "pred", "prediction")


# --- metrics -----------------------------------------------------------------------------------------------------

_JUDGED = """judged AS (SELECT event_id, floor(value / 5.0) / 100.0 AS score, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END
  AS label, CASE WHEN floor(value / 5.0) / 100.0 > 0.1 THEN 1 ELSE 0 END AS pred FROM events)"""
_CURVE = f"""{_JUDGED}, per AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM judged GROUP BY score),
pts AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n,
  lead(pos) OVER w AS np, lead(neg) OVER w AS nn, row_number() OVER w AS i FROM per WINDOW w AS (ORDER BY score DESC))"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.floor(F.col("value") / 5.0) / F.lit(100.0)
    return adapters.table(spark, sf_dir, "events").select(
        "event_id", score.alias("score"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"),
        F.when(score > 0.1, 1).otherwise(0).alias("pred"))


@query(f"""WITH {_JUDGED}
SELECT 'predicted positive' AS predicted, count(*) FILTER (WHERE pred = 1 AND label = 1) AS labels_positive,
  count(*) FILTER (WHERE pred = 1 AND label = 0) AS labels_negative FROM judged
UNION ALL SELECT 'predicted negative', count(*) FILTER (WHERE pred = 0 AND label = 1),
  count(*) FILTER (WHERE pred = 0 AND label = 0) FROM judged""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_judged(spark, sf_dir))


@query(f"""WITH {_JUDGED}, c AS (SELECT md5('42:' || event_id) < '33333333' AS test, avg(CAST(pred = label AS INT)) AS accuracy,
  count(*) FILTER (WHERE pred = 1 AND label = 1) AS tp, count(*) FILTER (WHERE pred = 1) AS p,
  count(*) FILTER (WHERE label = 1) AS y FROM judged GROUP BY 1)
SELECT CASE WHEN test THEN 'test' ELSE 'train' END AS split, round(accuracy, 9) AS accuracy,
  CASE WHEN p > 0 THEN round(tp / p, 9) ELSE 0.0 END AS precision, CASE WHEN y > 0 THEN round(tp / y, 9) ELSE 0.0 END AS recall,
  CASE WHEN p + y > 0 THEN round(2 * tp / (p + y), 9) ELSE 0.0 END AS f1 FROM c""")
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of both parts of a split, each under its mask."""
    rows = sampling.stratified_split(_judged(spark, sf_dir), "label", "event_id", mode="threshold")
    return readers.union_all([
        metrics.classification(rows, mask=F.col("split") == part).select(
            F.lit(part).alias("split"), *_rounded({c: F.col(c) for c in ("accuracy", "precision", "recall", "f1")}, 9))
        for part in ("train", "test")])


@query(f"""WITH {_CURVE} SELECT score AS threshold, round(fp / n, 9) AS fpr, round(tp / p, 9) AS tpr FROM pts
WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg""")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = metrics.roc(metrics.curve_points(_judged(spark, sf_dir)))
    return points.select("threshold", *_rounded({c: F.col(c) for c in ("fpr", "tpr")}, 9))


@query(f"""WITH {_CURVE} SELECT score AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / p, 9) AS recall
FROM pts""")
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = metrics.precision_recall(metrics.curve_points(_judged(spark, sf_dir)))
    return points.select("threshold", *_rounded({c: F.col(c) for c in ("precision", "recall")}, 9))


@query(f"""WITH {_CURVE} SELECT score AS threshold, round(fp / n, 9) AS fpr, round(tp / p, 9) AS tpr FROM pts
WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole curve, from (0, 0) to (1, 1)."""
    points = metrics.roc(metrics.curve_points(_judged(spark, sf_dir)), ends=True)
    return points.select("threshold", *_rounded({c: F.col(c) for c in ("fpr", "tpr")}, 9))


@query(f"""WITH {_CURVE} SELECT score AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / p, 9) AS recall
FROM pts UNION ALL SELECT NULL, 1.0, 0.0""")
def precision_recall_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = metrics.precision_recall(metrics.curve_points(_judged(spark, sf_dir)), ends=True)
    return points.select("threshold", *_rounded({c: F.col(c) for c in ("precision", "recall")}, 9))


@query(f"""WITH {_CURVE}, rates AS (SELECT *, tp / (tp + fp) AS prec, coalesce(lag(tp / (tp + fp)) OVER (ORDER BY score DESC), 1.0)
  AS before FROM pts)
SELECT round(sum(neg * (2 * tp - pos) / 2.0) / max(p * n), 9) AS roc_auc,
  round(sum(pos * (prec + before) / 2.0) / max(p), 9) AS pr_auc, round(sum(pos * prec) / max(p), 9) AS average_precision
FROM rates""")
def auc_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.areas(metrics.curve_points(_judged(spark, sf_dir)))
    return found.select(*_rounded({c: F.col(c) for c in found.columns}, 9))


@query(f"""WITH {_MLP} SELECT round(avg(ln(exp(l0) + exp(l1)) - CASE label WHEN 1 THEN l1 ELSE l0 END), 9) AS cross_entropy
FROM scored""")
def cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cross_entropy(_scored(spark, sf_dir)).select(F.round("cross_entropy", 9).alias("cross_entropy"))


# --- training ----------------------------------------------------------------------------------------------------

def _split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.prepare(adapters.transactions(spark, sf_dir))
    return sampling.stratified_split(rows, "label")


_LEARNED = f"""{TXN}, labelled AS (SELECT idx, CAST(CAST(replace(amount, '$', '') AS DOUBLE) > 60 AS INT) AS label FROM txn),
keyed AS (SELECT idx, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || idx)) AS r FROM labelled),
sizes AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM labelled GROUP BY 1),
shared AS (SELECT *, total - CAST(ceil(0.2 * total) AS BIGINT) AS n_train FROM sizes),
floors AS (SELECT *, n * n_train // total AS base, n * n_train % total AS rest FROM shared),
quotas AS (SELECT label, n - base - CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
  <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS n_test FROM floors)"""


@query(f"""WITH {_LEARNED} SELECT CASE WHEN r <= n_test THEN 'test' ELSE 'train' END AS split, count(*) AS n,
  1 AS loss_below_base, 1 AS accuracy_above_base FROM keyed JOIN quotas USING (label) GROUP BY 1""")
def train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classifier trained on the card-merchant graph, with labels that follow from the amount: the rows of both splits, and whether
    its loss and accuracy are better than those of the label's share alone."""
    amount = F.regexp_replace("amount", "[$]", "").cast("double")
    labelled = adapters.transactions(spark, sf_dir).withColumn("is_fraud", F.when(amount > 60, "Yes").otherwise("No"))
    rows = sampling.stratified_split(features.prepare(labelled), "label")
    _, scored = model.train_edge_classifier(rows, "mlp", iterations=20)
    shares = scored.groupBy("split").agg(F.avg("label").alias("p"))
    base = -(F.col("p") * F.log("p") + (1 - F.col("p")) * F.log(1 - F.col("p")))
    return model.split_metrics(scored).join(shares, "split").select(
        "split", "n", (F.col("loss") < base).cast("int").alias("loss_below_base"),
        (F.col("accuracy") > F.greatest(F.col("p"), 1 - F.col("p"))).cast("int").alias("accuracy_above_base"))


@query(f"""WITH {TXN} SELECT idx, "user", 1 AS src_known, CAST(merchant_name <> 0 AS INT) AS dst_known, 1 AS in_range,
  1 AS agrees, 1 AS same FROM txn""")
def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions scored by a model that was saved and loaded again: the confidence is a probability, the prediction
    follows from it, and the model scores as it did before it was saved."""
    fitted, _ = model.train_edge_classifier(_split_rows(spark, sf_dir), "logistic", iterations=10)
    path = scratch_path(spark, "model")
    model.save(fitted, path)
    rows = adapters.transactions(spark, sf_dir)
    before = model.score(rows, fitted).select("idx", F.col("confidence").alias("before"))
    found = model.score(rows, model.load(spark, path)).join(before, "idx")
    flags = {"src_known": F.col("src_known"), "dst_known": F.col("dst_known"),
             "in_range": F.col("confidence").between(0.0, 1.0),
             "agrees": (F.col("prediction") == "Yes") == (F.col("prob1") > F.col("prob0")),
             "same": F.abs(F.col("confidence") - F.col("before")) < 1e-9}
    return found.select("idx", "user", *[flag.cast("int").alias(name) for name, flag in flags.items()])


def encoder_weights(seed: int = 7, heads: int = 4, width: int = 16, hidden: int = 32) -> neural.EncoderWeights:
    """Random weights in the encoder's shape: no trained ones are published."""
    r = np.random.default_rng(seed)

    def w(*shape):
        return r.normal(0.0, 0.3, shape)

    return neural.EncoderWeights(
        w(heads, width), w(heads, width), w(heads * width), w(heads * width, width), w(1, width), w(1, width), w(width),
        [(w(7, hidden), w(hidden)), (w(hidden, width), w(width))], [(w(4 * width, width), w(width)), (w(width, 2), w(2))])


_SMALL = encoder_weights(heads=2, width=2, hidden=3)


def _linear(columns: list[str], weights, bias, j: int) -> str:
    return " + ".join([f"{w:.17e} * {c}" for c, w in zip(columns, weights[:, j])] + [f"{bias[j]:.17e}"])


def _sql_attention(name: str, vec: str, att_src, att_dst, bias, averaged: bool) -> str:
    """CTEs for one layer over ``vec(g, id, h0, …)`` and ``msg(g, s, d)``; graphs ``g`` are apart from each other."""
    heads, width = att_src.shape
    logits = ", ".join(" + ".join(
        f"{att_src[k][i]:.17e} * a.h{k * width + i} + {att_dst[k][i]:.17e} * b.h{k * width + i}" for i in range(width))
        + f" AS e{k}" for k in range(heads))
    shares = ", ".join(f"exp(greatest(e{k}, 0.2 * e{k}) - max(greatest(e{k}, 0.2 * e{k})) OVER (PARTITION BY g, d)) AS w{k}"
                       for k in range(heads))
    sums = [f"sum(w{k} * h{k * width + i}) / sum(w{k})" for k in range(heads) for i in range(width)]
    assert not averaged or heads == 1
    z = ", ".join(f"{x} + {bias[i]:.17e} AS z{i}" for i, x in enumerate(sums))
    return f"""{name}_e AS (SELECT m.g, m.d, {', '.join(f'a.h{i}' for i in range(heads * width))}, {logits} FROM msg m
  JOIN {vec} a ON a.g = m.g AND a.id = m.s JOIN {vec} b ON b.g = m.g AND b.id = m.d),
{name}_w AS (SELECT *, {shares} FROM {name}_e),
{name} AS (SELECT g, d AS id, {z} FROM {name}_w GROUP BY g, d)"""


def _sql_scores(msg: str, vec: str, ends: str) -> str:
    """Both layers, the edge perceptron and the classifier. ``ends`` joins the vectors of an edge's nodes as s and d."""
    w, hidden = _SMALL, [f"(CASE WHEN z{i} > 0 THEN z{i} ELSE exp(z{i}) - 1 END)" for i in range(4)]
    first = [f"greatest(0.0, {_linear([f'a{i}' for i in range(7)], *w.edge_layers[0], j)})" for j in range(3)]
    full = ["s.z0", "s.z1", "d.z0", "d.z1", *[_linear(["u0", "u1", "u2"], *w.edge_layers[1], j) for j in range(2)],
            "abs(s.z0 - d.z0)", "abs(s.z1 - d.z1)"]
    unit = [f"greatest(0.0, {_linear([f'x{i}' for i in range(8)], *w.classifier[0], j)})" for j in range(2)]
    return f"""WITH {_AMOUNTS}, cards AS (
  SELECT "user" || '_' || card AS k, row_number() OVER (ORDER BY min(idx)) - 1 AS id FROM txn GROUP BY 1),
merchants AS (SELECT merchant_name AS k, row_number() OVER (ORDER BY min(idx)) - 1 + (SELECT count(*) FROM cards) AS id
  FROM txn GROUP BY 1),
attr AS (SELECT idx, amount AS a0, dense_rank() OVER (ORDER BY merchant_city) - 1 AS a1,
  dense_rank() OVER (ORDER BY use_chip) - 1 AS a2, "year" AS a3, "month" AS a4, "day" AS a5,
  dense_rank() OVER (ORDER BY coalesce(errors, 'No error')) - 1 AS a6 FROM
  (SELECT idx, merchant_city, use_chip, errors, {_SCALED} FROM priced)),
edges AS (SELECT txn.idx, c.id AS src, m.id AS dst FROM txn JOIN cards c ON c.k = "user" || '_' || card
  JOIN merchants m ON m.k = merchant_name),
ids AS (SELECT id FROM cards UNION ALL SELECT id FROM merchants),
weights AS (SELECT id, {', '.join(f'(id * {i + 3} % 17) / 17.0 - 0.5 AS h{i}' for i in range(4))} FROM ids),
msg AS ({msg}), vec AS ({vec}),
{_sql_attention('one', 'vec', w.att_src1, w.att_dst1, w.bias1, False)},
mid AS (SELECT g, id, {', '.join(_linear(hidden, w.linear2, np.zeros(2), j) + f' AS h{j}' for j in range(2))} FROM one),
{_sql_attention('two', 'mid', w.att_src2, w.att_dst2, w.bias2, True)},
shaped AS (SELECT idx, {', '.join(f'{x} AS u{j}' for j, x in enumerate(first))} FROM attr),
joined AS (SELECT edges.*, {', '.join(f'{x} AS x{i}' for i, x in enumerate(full))} FROM edges JOIN shaped USING (idx) {ends}),
units AS (SELECT idx, src, dst, {', '.join(f'{x} AS y{j}' for j, x in enumerate(unit))} FROM joined),
logits AS (SELECT idx, src, dst, {', '.join(_linear(['y0', 'y1'], *w.classifier[1], j) + f' AS l{j}' for j in range(2))}
  FROM units)
SELECT idx, src, dst, round(exp(l1) / (exp(l0) + exp(l1)), 6) AS confidence, CASE WHEN l1 > l0 THEN 'Yes' ELSE 'No' END
  AS prediction FROM logits"""


def weight_table(nodes: DataFrame, size: int) -> DataFrame:
    """Stand-in rows of the first layer's weight table."""
    return nodes.select("node_id", F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: F.pmod(F.col("node_id") * (i + 3), F.lit(17)) / F.lit(17.0) - F.lit(0.5)).alias("h"))


def _attributed(spark: SparkSession, sf_dir: str) -> graph.Graph:
    rows = features.prepare(adapters.transactions(spark, sf_dir))
    nodes = graph.bipartite_nodes(rows)
    coded = features.apply_label_codes(rows, features.fit_label_codes(rows, features.CODED), spread=["idx"])
    scaled = features.apply_minmax(coded, features.fit_minmax(rows, features.SCALED))
    edges = graph.resolve_edges(scaled.withColumn("edge_attr", features.edge_attr()), nodes, spread=["idx"])
    return graph.Graph(nodes, edges.select("idx", "src", "dst", "edge_attr", "label"))


@query(_sql_scores("SELECT 0 AS g, src AS s, dst AS d FROM edges UNION ALL SELECT 0, id, id FROM ids",
                   "SELECT 0 AS g, * FROM weights", "JOIN two s ON s.id = src JOIN two d ON d.id = dst"))
def encoder_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two attention layers over the whole graph, then the edge classifier."""
    g = _attributed(spark, sf_dir)
    vectors = neural.encode(weight_table(g.nodes, 4), g.edges, _SMALL)
    scored = neural.classify_edges(g.edges, vectors, _SMALL)
    return scored.select("idx", "src", "dst", F.round("confidence", 6).alias("confidence"), "prediction")


@query(_sql_scores("""SELECT idx AS g, src AS s, dst AS d FROM edges UNION ALL SELECT idx, src, src FROM edges
  UNION ALL SELECT idx, dst, dst FROM edges""",
                   "SELECT idx AS g, weights.* FROM edges JOIN weights ON id = src OR id = dst",
                   "JOIN two s ON s.g = idx AND s.id = src JOIN two d ON d.g = idx AND d.id = dst"))
def request_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each transaction scored on the graph of its own edge."""
    g = _attributed(spark, sf_dir)
    table = weight_table(g.nodes, 4)
    scored = neural.score_requests(g.edges, table, _SMALL, table_bytes(table), spread=["idx"])
    return scored.select("idx", "src", "dst", F.round("confidence", 6).alias("confidence"), "prediction")


@query(f"""WITH {EDGE}, split AS (SELECT substr(md5('42:' || l_orderkey || '-' || l_linenumber || '-' || l_partkey), 1, 8) < '33333333' AS test FROM edge)
SELECT epoch, (SELECT count(*) FROM split WHERE NOT test) AS n_train, CAST(epoch > 0 AS INT) AS loss_fell, 1 AS scores_as_trained
FROM (SELECT unnest([0, 1, 2]) AS epoch)""")
def encoder_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attention encoder fitted to all payments for two steps: the loss before each and at the end, which the saved weights give too."""
    with shuffles_deleted(spark), staged_until_done(spark):
        rows = _encoder_losses(spark, sf_dir)
    return spark.createDataFrame(rows, "epoch int, n_train long, loss_fell int, scores_as_trained int")


def _encoder_losses(spark: SparkSession, sf_dir: str) -> list[tuple[int, int, int, int]]:
    g = _payments(spark, sf_dir)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    attr = F.array(F.col("amount") / 100000.0, "l_discount", "l_tax", F.col("l_quantity") / 50.0)
    edges = sampling.stratified_split(g.edges.select("src", "dst", attr.alias("edge_attr"), "label", key.alias("key")), "label", "key", mode="threshold")
    edges = stage(edges.drop("key"), "labelled-payments")
    trained = training.train_encoder(g.nodes, edges, heads=2, width=4, hidden=8, epochs=2, rate=0.01)
    path = scratch_path(spark, "encoder")
    training.save_encoder(trained, path)
    let_go(trained.table)
    table, weights = training.load_encoder(spark, path)
    scored = neural.classify_edges(edges.where("split = 'train'"), neural.encode(table, edges, weights), weights)
    found = metrics.cross_entropy(scored).first()[0]
    n_train = edges.where("split = 'train'").count()
    losses = [h["train_loss"] for h in trained.history]
    return [(i, n_train, int(i > 0 and loss < losses[i - 1]), int(abs(found - losses[-1]) < 1e-9)) for i, loss in enumerate(losses)]
