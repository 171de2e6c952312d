"""Readers. Every schema is declared; ``fmt`` names the file format (``parquet``, or ``avro`` where it is deployed)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cardlake.functions.cleaning import strip
from cardlake.operators.cleaning import select_present
from cardlake.operators.graph import Relation
from cardlake.operators.ordering import running_totals
from cardlake.schemas import Enforced
from cardlake.session import stage
from cardlake.sources import csv_records

CORRUPT = "_corrupt"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, corrupt: bool = False,
             multi_line: bool = True, header: bool = True, index: str | None = None) -> DataFrame:
    """CSV, by default with a header row. With ``corrupt`` lines that do not fit are kept whole in the column ``_corrupt``.

    An empty field is null, quoted or not. Large files are split. Line breaks inside quotes belong to their field; a pass over the quotes tells where there are any.
    ``multi_line=False`` saves that pass where no field can hold one. ``index`` adds a first column of that name, the row's
    number in the order of the files.
    """
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if multi_line:
        lines = csv_records.read_lines(spark.read, path)
        states = stage(csv_records.split_states(lines), "split-states")
        if not states.where("starts_inside or spans").isEmpty():
            records = csv_records.cut_records(lines, states, header)
            rows = csv_records.parse_records(records, schema, CORRUPT if corrupt else None)
            return file_order_index(rows, index) if index else rows.drop(*csv_records.PLACE)
    reader = spark.read.schema(schema).option("header", header).option("escape", '"').option("mode", "PERMISSIVE")
    rows = (reader.option("columnNameOfCorruptRecord", CORRUPT) if corrupt else reader).csv(path)
    return file_order_index(rows, index) if index else rows


def file_order_index(df: DataFrame, name: str = "idx", start: int = 0) -> DataFrame:
    """Number the rows of a table just read from files in the order they stand there; the index is the first column.

    The rows are written once with the place where they were read: file, split, and number in the split. Counts and
    positions both come from that table, so it does not matter how another scan would split the files. Files stand in
    the order of their folder, the number in their name and their name. Only the small table of splits is sorted.
    """
    file, block, row = csv_records.PLACE
    columns = [c for c in df.columns if c not in csv_records.PLACE]
    if file not in df.columns:
        df = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(block),
                       F.monotonically_increasing_id().alias(row))
    located = stage(df, "located")
    number = F.regexp_extract(F.element_at(F.split(file, "/"), -1), r"(\d+)", 1)
    splits = stage(located.groupBy(file, block).agg(F.count("*").alias("n"), F.min(row).alias("__first"))
                   .withColumn("__folder", F.regexp_replace(file, "/[^/]*$", ""))
                   .withColumn("__digits", F.length(number)).withColumn("__number", number), "splits")
    before, _ = running_totals(splits, ["__folder", "__digits", "__number", file, block], ["n"])
    before = before.select(file, block, "__first", (F.col("cum_n") - F.col("n") + start).alias("__before"))
    index = F.col("__before") + F.col(row) - F.col("__first")
    return located.join(before, [file, block]).select(index.alias(name), *[c for c in columns if c != name])


def read_topic(spark: SparkSession, root: str, topic: str, schema: T.StructType, columns: Sequence[str] | None = None,
               predicate: Column | None = None, fmt: str = "parquet") -> DataFrame:
    """All rows of ``topics/<topic>``; if a stream wrote it, only what its commit log names.

    Columns that a file lacks are null, no file at all gives no rows, and both the projection and the predicate reach the
    scan.
    """
    base = f"{root}/topics/{topic}"
    if _glob(spark, f"{base}/_spark_metadata"):
        # A commit log is read with the schema as given, so what older files lack must be allowed to be null.
        nullable = [T.StructField(f.name, f.dataType) for f in schema.fields]
        df = spark.read.format(fmt).schema(T.StructType([*nullable, T.StructField("partition", T.IntegerType())])).load(base)
    else:
        found = _glob(spark, f"{base}/partition=*")
        reader = spark.read.format(fmt).schema(schema).option("basePath", base).option("pathGlobFilter", f"*.{fmt}")
        df = reader.load(found) if found else spark.createDataFrame([], schema)
    if predicate is not None:
        df = df.where(predicate)
    return select_present(df, columns or schema.fieldNames())


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    hits = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(h.getPath()) for h in hits or [])


def read_stage(spark: SparkSession, root: str, name: str, ds: str | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """A staged table, or only the rows of one run date. With ``schema`` a table without any rows can be read."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*[f for f in schema.fields if f.name != "ds"], T.StructField("ds", T.StringType())]))
    df = reader.parquet(f"{root}/{name}")
    return df if ds is None else df.where(F.col("ds") == ds).drop("ds")


def read_prefix_with_file(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Datasets under ``path`` with ``file_name``, the name of the dataset, and ``table``, that name up to its first underscore.

    A dataset is a file right under ``path`` or a folder there, whatever the names and folders of the parts in it.
    """
    df = (spark.read.format(fmt).schema(schema).option("recursiveFileLookup", True)
          .option("pathGlobFilter", f"*.{fmt}").load(path))
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    depth = len(re.sub(r":/+", ":/", root).rstrip("/").split("/"))
    parts = F.split(F.regexp_replace("_metadata.file_path", r"^([a-z0-9]+):/+", "$1:/"), "/")
    name = F.url_decode(F.element_at(parts, depth + 1))
    return df.select("*", name.alias("file_name"), F.element_at(F.split(name, "_"), 1).alias("table"))


def list_datasets(spark: SparkSession, prefix: str, suffix: str = ".parquet") -> list[str]:
    """Paths of the datasets under ``prefix``: files or folders whose name ends with ``suffix``, and staged tables."""
    staged = {p.rstrip("/").rsplit("/", 1)[0] for p in _glob(spark, f"{prefix}/*/ds=*")}
    return sorted({*_glob(spark, f"{prefix}/*{suffix}"), *staged})


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text)``, one row per file."""
    return (spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows over the union of the columns; what a frame lacks is null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, n)``."""
    return union_all([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
                      for name, df in tables.items()])


# --- graph files -------------------------------------------------------------------------------------------------

_EDGE = T.StructType([T.StructField("src", T.StringType()), T.StructField("dst", T.StringType())])


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder``, in order."""
    return [p.rsplit("/", 1)[1] for p in _glob(spark, f"{folder}/*") if not p.rsplit("/", 1)[1].startswith(("_", "."))]


def read_edgelist(spark: SparkSession, path: str, header: bool = True, source_type: str = "user",
                  sink_type: str = "user", skip_first: bool = False) -> Relation:
    """An edge list; a header row names the two node types. An empty field is the empty id, and its edge counts.

    ``skip_first`` drops the first row of a file without a header too.
    """
    if header:
        source_type, sink_type = spark.read.option("header", True).csv(path).columns
    rows = read_csv(spark, path, _EDGE, header=header, index="row")
    if skip_first and not header:
        rows = rows.where(F.col("row") > 0)
    return Relation(source_type, sink_type, rows.select("row", *[F.coalesce(c, F.lit("")).alias(c) for c in ("src", "dst")]))


def _feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """(row, line, key, texts, features) of the lines of a feature file that are not empty; there is no header."""
    lines = file_order_index(spark.read.text(path).withColumnRenamed("value", "line"), "row").where(strip(F.col("line")) != "")
    parts = F.split(strip(F.col("line")), ",")

    def number(text: Column) -> Column:
        low = F.lower(strip(text))
        return F.when(low == "true", 1.0).when(low == "false", 0.0).otherwise(low.try_cast("double"))

    told = lines.withColumn("parts", parts).select("row", "line", F.element_at("parts", 1).alias("key"),
                                                   F.slice("parts", F.lit(2), F.size("parts")).alias("texts"))
    return told.withColumn("features", F.transform("texts", number))


def read_node_features(spark: SparkSession, path: str) -> DataFrame:
    """``(row, key, features)`` from lines of an id and numbers or ``true`` / ``false``; what is neither is null."""
    return _feature_lines(spark, path).select("row", "key", "features")


def enforce_node_features(spark: SparkSession, path: str) -> Enforced:
    """The lines that hold nothing but numbers, as many as the first line, and ``(row, line, reasons)`` of the others."""
    lines = stage(_feature_lines(spark, path), "feature-lines")
    width = lines.agg(F.min_by(F.size("texts"), "row")).first()[0] or 0
    odd = F.when(F.size("texts") != width, F.concat(F.size("texts").cast("string"), F.lit(f" values instead of {width}")))
    words = F.transform(F.filter(F.arrays_zip("texts", "features"), lambda e: e["features"].isNull()),
                        lambda e: F.concat(F.lit("not a number: "), e["texts"]))
    checked = lines.withColumn("reasons", F.array_compact(F.concat(F.array(odd), words)))
    return Enforced(checked.where(F.size("reasons") == 0).select("row", "key", "features"),
                    checked.where(F.size("reasons") > 0).select("row", "line", "reasons"))


def read_masked_nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(strip(F.col("value")).alias("key")).where(F.col("key") != "")


def read_labels(spark: SparkSession, path: str, target: str) -> DataFrame:
    """``(key, label)`` from a table whose key column is named after the target type."""
    raw = spark.read.option("header", True).csv(path)
    label = next(c for c in raw.columns if c != target)
    return raw.select(F.col(target).alias("key"), F.col(label).try_cast("int").alias("label"))
