"""Jobs that fill vector collections: tables as documents, records with a text field, folders of documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake.functions import text as tx
from cardlake.operators import text, vectors
from cardlake.session import stage, staged_until_done
from cardlake.sources.readers import file_order_index, list_datasets, read_documents
from cardlake.sources.sinks import replace_partition

Embed = Callable[[Column], Column]


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def lines_path(collection: str) -> str:
    """Where the whole texts of a collection's tables stand, line by line."""
    return f"{collection.rstrip('/')}_lines"


def _numbered(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    rows = spark.read.parquet(path)
    return file_order_index(rows, "pos").withColumn("file_name", F.lit(_name(path))), rows.columns


def table_rows(spark: SparkSession, path: str, embed: Embed, prefix: int = text.PREFIX,
               numbered: tuple[DataFrame, list[str]] | None = None) -> DataFrame:
    """One collection row ``(id, embedding, document, metadata)`` for the dataset at ``path``.

    The document is the beginning of the table's CSV text, which is also what is embedded. A whole table does not fit into
    one row; its text stands line by line beside the collection (see :func:`index_tables`).
    """
    named, columns = numbered or _numbered(spark, path)
    document = text.table_documents(named, columns, prefix=prefix)
    metadata = F.create_map(
        F.lit("table"), F.col("table"), F.lit("file_name"), F.col("file_name"),
        F.lit("row_count"), F.col("row_count").cast("string"), F.lit("columns"), F.col("columns"))
    return document.select(F.col("file_name").alias("id"), embed(F.col("text")).alias("embedding"),
                           F.col("text").alias("document"), metadata.alias("metadata"))


def index_tables(spark: SparkSession, prefix: str, collection: str, embed: Embed) -> None:
    """Add every dataset under ``prefix`` to the collection. Those whose file name is there already are not read.

    The whole CSV text of each goes to :func:`lines_path` as ``(line_no, line, id)`` with the header as line 0. It is
    written first and replaces itself, so a run that broke off in between leaves no second copy.
    """
    paths = {_name(path): path for path in list_datasets(spark, prefix)}
    known = vectors.known_ids(spark, collection, list(paths))
    for name, path in paths.items():
        if name not in known:
            with staged_until_done(spark):
                named, columns = numbered = _numbered(spark, path)
                header = spark.createDataFrame([(0, tx.csv_header(columns))], "line_no long, line string")
                lines = text.table_lines(named, columns, ["pos"]).select((F.col("pos") + 1).alias("line_no"), "line")
                replace_partition(header.unionByName(lines), lines_path(collection), "id", name)
                vectors.add_to_collection(collection, table_rows(spark, path, embed, numbered=numbered))


def index_records(records: DataFrame, collection: str, order_by: Sequence[str], embed: Embed, start: int = 0) -> None:
    """Append the texts of ``records`` (``content`` or ``message``) under ids that continue from ``start``."""
    with staged_until_done(records.sparkSession):
        picked = text.pick_text(records).withColumnRenamed("text", "raw_text")
        numbered = vectors.insert_batch(picked, ["raw_text"], order_by, start)
        numbered.withColumn("embedding", embed(F.col("raw_text"))).write.mode("append").parquet(collection)


def index_documents(spark: SparkSession, folder: str, collection: str, embed: Embed) -> None:
    """Append the chunks of all files in a folder; a chunk's id is its file's path and its number."""
    with staged_until_done(spark):
        chunks = stage(text.chunk(read_documents(spark, folder)), "chunks")
        rows = chunks.select(F.concat_ws("#", "path", "chunk_no").alias("id"), embed(F.col("chunk")).alias("embedding"),
                             F.col("chunk").alias("document"))
        vectors.add_to_collection(collection, rows)
