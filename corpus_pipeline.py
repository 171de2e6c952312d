"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, contaminated documents go, secrets are
blotted out, and what is left is encoded.

Decisions are made per doc_id: if rows share an id, the verdict on one holds for all; equal rows of one id are one document after
the join stage. A row without an id is never dropped. Empty tables give empty results in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.llm import bpe, decontaminate, jaccard_join, secrets, toxicity
from cardlake.session import stage


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is not among ``ids`` (few, so their table is written first and Spark sees its size)."""
    return docs.join(stage(ids.select("doc_id").distinct(), "dropped"), "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit_toxicity(toxicity.training_rows(spark, sf_dir))
    return _without(docs, model.score(docs).filter("predicted = 1"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    linked = stage(jaccard_join.link_documents(docs), "linked")
    left = _without(docs, linked.filter("component_id <> doc_id"))
    repeated = linked.groupBy("doc_id").count().filter("count > 1 and doc_id is not null")
    if repeated.isEmpty():
        return left
    repeated = stage(repeated.select("doc_id"), "repeated")
    return left.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(
        left.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.filter(decontaminate.contaminated()))


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.fit_planted(docs))
    if "n_chars" in docs.columns:
        changed = F.when(F.contains("text", F.lit(secrets.MARK)), F.length("text").cast("long"))
        clean = clean.withColumn("n_chars", F.coalesce(changed, "n_chars"))
    return clean.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, bpe.default_vocabulary(), ids=False, remembered=80_000)  # beside JVMs that earlier stages filled


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("secret_scan", blot_secrets), ("bpe", encode)]

# Boosted trees, connected components and BPE are beyond SQL. tests/llm compares run() with the stages' decisions taken one by one, and the
# join, decontamination and encoding stages with brute force by themselves.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
