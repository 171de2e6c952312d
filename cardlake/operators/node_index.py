"""A node index that outlives one job: later relations extend it, and no id ever changes.

``<path>/nodes/version=<n>`` holds the nodes that the n-th extension added, ``<path>/marks/version=<n>`` the first free id of every
type behind it. The marks are written last: an extension counts only once they are there, and one that broke off before is written
anew under the same number. One job extends an index at a time; any number may read it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.operators.graph import Relation, _first_seen, _numbered
from cardlake.session import stage

_NODES = "node_id long, type string, key string, degree long"


def _marks(spark: SparkSession, path: str) -> tuple[int, dict[str, int]]:
    """The last version, and the first free id per type; a graph has few types."""
    try:
        marks = spark.read.schema("type string, next_id long, version int").parquet(f"{path}/marks")
    except AnalysisException:
        return -1, {}
    last = marks.agg(F.max("version")).first()[0]
    return (-1, {}) if last is None else (last, {r["type"]: r["next_id"] for r in marks.where(F.col("version") == last).collect()})


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All nodes ``(node_id, type, key, degree)`` of the finished extensions; ``degree`` counts the rows that first brought them."""
    last, _ = _marks(spark, path)
    if last < 0:
        return spark.createDataFrame([], _NODES)
    nodes = spark.read.schema(f"{_NODES}, version int").parquet(f"{path}/nodes")
    return nodes.where(F.col("version") <= last).drop("version")


def append_nodes(spark: SparkSession, path: str, fresh: DataFrame) -> None:
    """Add nodes whose ids follow the marks, and then the marks."""
    last, start = _marks(spark, path)
    fresh.select("node_id", "type", "key", "degree").write.mode("overwrite").parquet(f"{path}/nodes/version={last + 1}")
    after = start | {r["type"]: r["next"] for r in fresh.groupBy("type").agg((F.max("node_id") + 1).alias("next")).collect()}
    (spark.createDataFrame(sorted(after.items()), "type string, next_id long").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/marks/version={last + 1}"))


def extend_index(spark: SparkSession, path: str, relations: Sequence[Relation]) -> DataFrame:
    """Give ids to the nodes of ``relations`` that the index lacks, as first seen behind those of their type; returns all nodes."""
    known, (_, start) = read_index(spark, path), _marks(spark, path)
    fresh = _first_seen(relations).join(known.select("type", "key"), ["type", "key"], "left_anti")
    append_nodes(spark, path, _numbered(stage(fresh, "new-keys"), start, "new-nodes"))
    return read_index(spark, path)
