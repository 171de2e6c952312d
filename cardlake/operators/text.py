"""Texts to index: picked fields, chunks, batches, and tables written out as documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cardlake.functions import cleaning as fn, text as tx
from cardlake.operators.ordering import dense_index, index_within

PREFIX = 1500
BATCH = 100


def pick_text(records: DataFrame, content: str = "content", message: str = "message") -> DataFrame:
    """Add ``text``, the first usable of the two fields, and drop records without any."""
    fields = [F.col(c) if c in records.columns else F.lit(None).cast("string") for c in (content, message)]
    return records.withColumn("text", fn.text_field(*fields)).where(fn.strip(F.col("text")) != "")


def chunk(documents: DataFrame, text: str = "text", size: int = tx.CHUNK_SIZE, overlap: int = tx.OVERLAP) -> DataFrame:
    """One row per chunk, with ``chunk_no`` from 0 and ``chunk`` in place of the text."""
    rest = [c for c in documents.columns if c != text]
    return documents.select(*rest, F.posexplode(tx.chunks(F.col(text), size, overlap)).alias("chunk_no", "chunk"))


def batch_no(records: DataFrame, order_by: Sequence[str], size: int = BATCH, by: Sequence[str] = ()) -> DataFrame:
    """Add ``pos``, the position in the order, and ``batch_no``, the number of its batch of ``size`` rows, from 0.

    With ``by``, such as the file a record comes from, both start anew in each group.
    """
    numbered = index_within(records, by, order_by, "pos") if by else dense_index(records, order_by, "pos")
    return numbered.withColumn("batch_no", F.floor(F.col("pos") / size).cast("long"))


def table_lines(rows: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The whole document of a table in a form that scales: one CSV line per row, next to the ``keep`` columns."""
    return rows.select(*keep, tx.csv_line(columns).alias("line"))


def table_documents(rows: DataFrame, columns: Sequence[str], file: str = "file_name", order_by: Sequence[str] = ("pos",),
                    prefix: int = PREFIX) -> DataFrame:
    """One row per file: ``file_name, table, row_count, columns, text`` with the first ``prefix`` characters of its CSV.

    A CSV line of k columns has at least k characters with its line break, so the first ``prefix / k`` rows always reach
    the cut; only these are gathered, found by a top-n per file that each task applies before the shuffle.
    """
    header = tx.csv_header(columns) + "\n"
    need = max(1, -(-prefix // max(2, len(columns))))
    # What stands behind the prefix of a line is in no document; it is cut off before the lines travel.
    lines = table_lines(rows, columns, [file, *order_by]).withColumn("line", F.substring("line", 1, prefix))
    place = F.row_number().over(Window.partitionBy(file).orderBy(*order_by))
    ranked = lines.withColumn("r", place).where(F.col("r") <= need)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "line"))), lambda s: s["line"]), "\n")
    texts = ranked.groupBy(file).agg(
        F.substring(F.concat(F.lit(header), joined, F.lit("\n")), 1, prefix).alias("text"))
    counts = rows.groupBy(file).agg(F.count("*").alias("row_count"))
    return counts.join(texts, file).select(
        F.col(file).alias("file_name"), F.element_at(F.split(file, "_"), 1).alias("table"), "row_count",
        F.lit(",".join(columns)).alias("columns"), "text")
