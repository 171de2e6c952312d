"""Texts, table documents, embeddings and retrieval."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.operators import collection, text, vectors
from cardlake.operators.lookups import table_bytes
from cardlake.plans import indexing
from cardlake.plans.registry import query
from cardlake.session import scratch_path
from cardlake.sources import adapters, readers

_DIM = 64
_FILE_BYTES = 64 << 20  # of a staged file, as its rows take in memory


@query("""SELECT doc_id, lang, CAST(i AS INT) AS chunk_no, substr(text, CAST(i * 250 + 1 AS BIGINT), 300) AS chunk
FROM documents, LATERAL (SELECT unnest(range(0, CAST(ceil(length(text) / 250.0) AS BIGINT))) AS i)""")
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.chunk(adapters.table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


def _cell(c: str) -> str:
    return f"""coalesce(CASE WHEN regexp_matches({c}, '[,"\\r\\n]') THEN '"' || replace({c}, '"', '""') || '"' ELSE {c} END, '')"""


@query(f"""WITH lines AS (
  SELECT 'documents_20240701.parquet' AS file_name, 'doc_id,lang,text' AS columns, doc_id AS pos,
    doc_id || ',' || {_cell('lang')} || ',' || {_cell('text')} AS line FROM documents
  UNION ALL SELECT 'customer_20240701.parquet', 'c_custkey,c_name,c_mktsegment', c_custkey,
    c_custkey || ',' || {_cell('c_name')} || ',' || {_cell('c_mktsegment')} FROM customer)
SELECT file_name, split_part(file_name, '_', 1) AS "table", count(*) AS row_count, columns,
  substr(columns || chr(10) || string_agg(line, chr(10) ORDER BY pos) || chr(10), 1, 1500) AS text
FROM lines GROUP BY file_name, columns""")
def table_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = []
    for name, key, columns in (("documents", "doc_id", ["doc_id", "lang", "text"]),
                               ("customer", "c_custkey", ["c_custkey", "c_name", "c_mktsegment"])):
        rows = adapters.table(spark, sf_dir, name).select(
            *columns, F.lit(f"{name}_20240701.parquet").alias("file_name"), F.col(key).alias("pos"))
        docs.append(text.table_documents(rows, columns))
    return readers.union_all(docs)


@query("""SELECT conv_id, turn, CASE role WHEN 'system' THEN 'note ' || turn ELSE text END AS text FROM conversations
WHERE role <> 'assistant' AND trim(text) <> ''""")
def picked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System turns carry their text in ``content``, user turns in ``message``; assistant turns have blanks only."""
    role = F.col("role")
    records = adapters.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.when(role == "system", F.concat(F.lit("note "), F.col("turn").cast("string"))).when(role == "user", "")
        .alias("content"),
        F.when(role == "assistant", " \n").otherwise(F.col("text")).alias("message"))
    return text.pick_text(records).select("conv_id", "turn", "text")


@query("""SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos,
  (row_number() OVER (ORDER BY conv_id, turn) - 1) // 100 AS batch_no FROM conversations""")
def embed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = adapters.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return text.batch_no(records, ["conv_id", "turn"])


@query("""WITH numbered AS (SELECT role, conv_id, turn, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS pos
  FROM conversations) SELECT *, pos // 100 AS batch_no FROM numbered""")
def file_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that start anew in each group, here the role in place of the file."""
    records = adapters.table(spark, sf_dir, "conversations").select("role", "conv_id", "turn")
    return text.batch_no(records, ["conv_id", "turn"], by=["role"])


_STAGED_LINES = f"""lines AS (
  SELECT 'documents_20240701.parquet' AS id, 'documents' AS "table", 'doc_id,lang,text' AS columns, doc_id AS pos,
    doc_id || ',' || {_cell('lang')} || ',' || {_cell('text')} AS line FROM documents
  UNION ALL SELECT 'customer_20240701.parquet', 'customer', 'c_custkey,c_name', c_custkey,
    c_custkey || ',' || {_cell('c_name')} FROM customer)"""


def _write_ordered(rows: DataFrame, key: str, path: str) -> None:
    """Four files in the order of ``key``, or as many as keep each at about ``_FILE_BYTES``."""
    files = max(4, -(-table_bytes(rows) // _FILE_BYTES))
    rows.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(path)


def _indexed(spark: SparkSession, sf_dir: str) -> str:
    """The nightly index: staged files → documents → vectors → collection; a second run adds nothing."""
    root = scratch_path(spark, "index")
    for name, columns in (("documents", ["doc_id", "lang", "text"]), ("customer", ["c_custkey", "c_name"])):
        rows = adapters.table(spark, sf_dir, name).select(*columns)
        _write_ordered(rows, columns[0], f"{root}/stage/{name}_20240701.parquet")
    for _ in range(2):
        indexing.index_tables(spark, f"{root}/stage", f"{root}/collection", partial(vectors.hashed_embedding, dim=_DIM))
    return f"{root}/collection"


@query(f"""WITH {_STAGED_LINES}
SELECT id, "table", CAST(count(*) AS VARCHAR) AS row_count, columns,
  substr(columns || chr(10) || string_agg(line, chr(10) ORDER BY pos) || chr(10), 1, 1500) AS document, 64 AS width
FROM lines GROUP BY id, "table", columns""")
def index_tables_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spark.read.parquet(_indexed(spark, sf_dir))
    meta = [F.col("metadata").getItem(k).alias(k) for k in ("table", "row_count", "columns")]
    return found.select("id", "document", F.size("embedding").alias("width"), *meta)


@query(f"""WITH {_STAGED_LINES}
SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) AS line_no, line FROM lines
UNION ALL SELECT DISTINCT id, 0, columns FROM lines""")
def index_whole_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text of each indexed table, line by line."""
    return spark.read.parquet(indexing.lines_path(_indexed(spark, sf_dir))).select("id", "line_no", "line")


@query("""SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS id, text AS raw_text, 64 AS width FROM conversations
WHERE trim(text) <> ''""")
def index_records_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a text field → vectors under automatic ids."""
    records = adapters.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("message"))
    path = scratch_path(spark, "records")
    indexing.index_records(records, path, ["conv_id", "turn"], partial(vectors.hashed_embedding, dim=_DIM))
    return spark.read.parquet(path).select("id", "raw_text", F.size("embedding").alias("width"))


@query("""SELECT file_name, split_part(file_name, '_', 1) AS "table", count(*) AS row_count, CAST(sum(key) AS BIGINT) AS key_sum FROM (
  SELECT 'customer_2024_a' AS file_name, c_custkey AS key FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT 'customer_2024_b', c_custkey FROM customer WHERE c_custkey % 2 = 1
  UNION ALL SELECT 'supplier', s_suppkey FROM supplier) GROUP BY 1""")
def prefix_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets found under a prefix; their names, and the tables they belong to, come from where their files lie."""
    root = scratch_path(spark, "prefix")
    customers = adapters.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    for name, rows in (("customer_2024_a", customers.where("key % 2 = 0")), ("customer_2024_b", customers.where("key % 2 = 1")),
                       ("supplier", adapters.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key")))):
        rows.write.parquet(f"{root}/{name}")
    found = readers.read_prefix_with_file(spark, root, customers.schema)
    return found.groupBy("file_name", "table").agg(F.count("*").alias("row_count"), F.sum("key").alias("key_sum"))


_TOKENS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}]+'), lambda t: t <> '')"
_HASHED = f"""slots AS (SELECT id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {_DIM} AS slot, count(*) AS c
  FROM (SELECT id, unnest({_TOKENS}) AS t FROM texts) GROUP BY 1, 2),
hashed AS (SELECT id, slot, c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS v FROM slots)"""


@query(f"""WITH texts AS (SELECT doc_id AS id, text FROM documents), {_HASHED}
SELECT id AS doc_id, CAST(slot AS INT) AS slot, round(v, 9) AS value FROM hashed""")
def hashed_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = adapters.table(spark, sf_dir, "documents")
    embedded = docs.select("doc_id", vectors.hashed_embedding(F.col("text"), _DIM).alias("e"))
    return embedded.select("doc_id", F.posexplode_outer("e").alias("slot", "value")).where(F.col("value") > 0) \
        .withColumn("value", F.round("value", 9))


def _centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean vector of each label, as query vectors."""
    parts = adapters.table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return means.groupBy("label").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("embedding")) \
        .withColumnRenamed("label", "query_id")


def _top_k(metric: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    collection = adapters.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    found = vectors.top_k(_centroids(spark, sf_dir), collection, metric=metric)
    return found.withColumn("distance", F.round("distance", 6))


_DISTANCE = {"l2": "sqrt(sum((q.v - e.v) * (q.v - e.v)))", "ip": "-sum(q.v * e.v)",
             "cosine": "1 - sum(q.v * e.v) / (sqrt(sum(q.v * q.v)) * sqrt(sum(e.v * e.v)))"}
for _metric, _formula in _DISTANCE.items():
    query(f"""WITH parts AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i,
      CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
    q AS (SELECT label AS query_id, i, avg(v) AS v FROM parts GROUP BY 1, 2),
    dist AS (SELECT query_id, vec_id AS id, round({_formula}, 9) AS distance FROM q JOIN parts e USING (i) GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM dist)
    SELECT query_id, CAST(rank AS INT) AS rank, id, round(distance, 6) AS distance FROM ranked WHERE rank <= 4
    """, f"vector_top_k_{_metric}")(partial(_top_k, _metric))


@query(f"""WITH texts AS (SELECT doc_id * 2 AS id, text FROM documents UNION ALL SELECT item_id * 2 + 1, text FROM benchmark),
{_HASHED},
dot AS (SELECT q.id AS q, d.id AS d, sum(q.v * d.v) AS s FROM hashed q JOIN hashed d USING (slot)
  WHERE q.id % 2 = 1 AND d.id % 2 = 0 GROUP BY 1, 2),
every AS (SELECT b.item_id AS query_id, x.doc_id AS id, round(1 - coalesce(s, 0), 9) AS distance FROM benchmark b
  JOIN documents x ON true LEFT JOIN dot ON q = item_id * 2 + 1 AND d = doc_id * 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM every)
SELECT query_id, CAST(rank AS INT) AS rank, id, round(distance, 6) AS distance, text AS document FROM ranked
JOIN documents ON doc_id = id WHERE rank <= 4""")
def retrieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as questions, documents as context."""
    provider = partial(vectors.hashed_embedding, dim=_DIM)
    collection = adapters.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("document"), provider(F.col("text")).alias("embedding"))
    questions = adapters.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = vectors.retrieve(questions, collection, provider, metric="cosine")
    return found.withColumn("distance", F.round("distance", 6))


@query("""SELECT vec_id AS id, label FROM embeddings WHERE label >= 5""")
def vector_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors come in twice; those of the first labels are already in the collection."""
    every = adapters.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", "label", F.lit(1).alias("pos"))
    again = every.withColumns({"label": F.lit(-1), "pos": F.lit(2)})
    collection = every.where(F.col("label") < 5)
    return vectors.insert_new(collection, every.unionByName(again), "pos").select("id", "label")


@query("""SELECT 1000 + row_number() OVER (ORDER BY conv_id, turn) - 1 AS id, text AS raw_text FROM conversations""")
def vector_insert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = adapters.table(spark, sf_dir, "conversations").withColumnRenamed("text", "raw_text")
    return vectors.insert_batch(records, ["raw_text"], ["conv_id", "turn"], 1000)


@query(f"""SELECT vec_id AS id, CASE WHEN vec_id % 3 = 0 THEN 'first' ELSE 'second' END AS source, label FROM embeddings""")
def vector_insert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed collection gets a third of the vectors, then all of them: those it has stay as they are."""
    path = scratch_path(spark, "bucketed")
    every = adapters.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    collection.insert_bucketed(path, every.where("id % 3 = 0").withColumn("source", F.lit("first")), buckets=64)
    collection.insert_bucketed(path, every.withColumn("source", F.lit("second")))
    return collection.read_collection(spark, path).select("id", "source", "label")


@query("""SELECT conv_id, turn, coalesce(length(text), 0) AS width, CAST(coalesce(text LIKE '%q%', false) AS INT) AS failed
FROM conversations""")
def provider_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts embedded by an outside provider that fails on some; their rows are flagged and hold zeros."""
    def provider(texts: list[str]) -> list[list[float]]:
        if any("q" in t for t in texts):
            raise RuntimeError("service down")
        return [[float(len(t)), 1.0] for t in texts]

    told = vectors.embed_with(adapters.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), provider, 2, batch=1)
    width = F.when(F.col("failed"), F.length("text").cast("double") * F.lit(1.0)).otherwise(F.get("embedding", F.lit(0)))
    zero = ~F.col("failed") | ((F.get("embedding", F.lit(0)) == 0.0) & (F.get("embedding", F.lit(1)) == 0.0))
    return told.select("conv_id", "turn", F.when(zero, width).cast("long").alias("width"), F.col("failed").cast("int").alias("failed"))


@query("""SELECT 'part=' || c_nationkey AS folder, CAST(sum(length(c_name || chr(10) || c_mktsegment || chr(10))) AS BIGINT) AS n
FROM customer GROUP BY c_nationkey""")
def documents_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of text files, one row each: all customers, a file per nation."""
    root = scratch_path(spark, "folder")
    rows = adapters.table(spark, sf_dir, "customer")
    (rows.select(F.concat_ws("\n", "c_name", "c_mktsegment").alias("value"), F.col("c_nationkey").alias("part"))
     .repartition("part").write.partitionBy("part").text(root))
    found = readers.read_documents(spark, root)
    return found.select(F.element_at(F.split("path", "/"), -2).alias("folder"), F.length("text").cast("long").alias("n"))
