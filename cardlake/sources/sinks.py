"""Writers."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, quotes doubled, space kept; a null is empty and an empty text is two quotes."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def replace_partition(df: DataFrame, path: str, by: str, value) -> None:
    """Write ``df`` as the whole partition ``by=value``; an empty ``df`` empties it and leaves a readable table."""
    rows = df.withColumn(by, F.lit(value))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    fs, folder = _folder(df.sparkSession, path)
    fs.mkdirs(folder)
    if df.isEmpty():  # a dynamic overwrite without rows replaces nothing
        fs.delete(_folder(df.sparkSession, f"{path}/{by}={value}")[1], True)


def write_stage(df: DataFrame, root: str, name: str, ds: str) -> str:
    """Stage a table under its run date; a second run of the date replaces the first."""
    replace_partition(df, f"{root}/{name}", "ds", ds)
    return f"{root}/{name}"


def batch_key(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A name for a batch that no other stream shares: the stream's id, as its checkpoint keeps it, and the number."""
    kept = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return f"{json.loads(kept)['id']}-{batch_id}"


def write_batch(df: DataFrame, path: str, batch: int | str) -> None:
    """Write one stream batch; when the stream repeats a batch it replaces its own files.

    ``batch`` is the batch's :func:`batch_key` where several streams, or one with a new checkpoint, write to ``path``.
    """
    replace_partition(df, path, "batch_id", batch)


def read_batch(spark: SparkSession, path: str, batch: int | str, schema: T.StructType | str) -> DataFrame:
    """The rows of one batch, without a look at the folders of the others."""
    fs, folder = _folder(spark, f"{path}/batch_id={batch}")
    if not fs.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch_id={batch}")


def drop_batch(spark: SparkSession, path: str, batch: int | str) -> None:
    fs, folder = _folder(spark, f"{path}/batch_id={batch}")
    fs.delete(folder, True)


def forget_commit(spark: SparkSession, checkpoint: str, batch_id: int) -> None:
    """Make a stream that is started again repeat its batch ``batch_id``, as it does after a driver was lost behind the writes."""
    fs, commit = _folder(spark, f"{checkpoint}/commits/{batch_id}")
    fs.delete(commit, False)


def sort_layout(df: DataFrame, sort_by: Sequence[str]) -> DataFrame:
    """Range-partition and sort, so that files and row groups hold narrow ranges of the key and scans can skip them.

    Name a unique column last: then rows that share a frequent value still spread over several tasks.
    """
    return df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str, ds: bool = True) -> None:
    """Create the table in the session catalog unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = (", `ds` string", "PARTITIONED BY (`ds`)") if ds else ("", "")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}{parts[0]}) USING parquet {parts[1]} LOCATION '{path}'")


def append_table(df: DataFrame, path: str, sort_by: Sequence[str], ds: str | None = None,
                 mode: str = "replace_ds") -> None:
    """Add rows to a table that is sorted by a key.

    ``replace_ds`` replaces what an earlier run of the date wrote; ``reference_append`` only adds, so a second run doubles
    the rows.
    """
    laid_out = sort_layout(df, sort_by)
    if mode == "replace_ds":
        if ds is None:
            raise ValueError("replace_ds needs a run date")
        replace_partition(laid_out, path, "ds", ds)
    elif mode == "reference_append":
        if ds is None:
            laid_out.write.mode("append").parquet(path)
        else:
            laid_out.withColumn("ds", F.lit(ds)).write.mode("append").partitionBy("ds").parquet(path)
    else:
        raise ValueError(f"unknown mode {mode!r}")
