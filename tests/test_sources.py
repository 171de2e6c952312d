import os

import pytest
from pyspark.sql import functions as F, types as T

from cardlake import schemas
from cardlake.operators import report
from cardlake.plans import questions
from cardlake.session import scratch_path, shared_folder, stage, staged_until_done
from cardlake.sources import readers, sinks
from tests.conftest import rows


class _Session:
    """What shared_folder asks of a session."""

    def __init__(self, named, master):
        self.folder, self.master, self.sparkContext = None, master, self
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: {"spark.checkpoint.dir": named}.get(key))})

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder(spark):
    assert shared_folder(_Session("hdfs:///x/", "yarn")) == "hdfs:///x"
    with pytest.raises(ValueError):
        shared_folder(_Session(None, "yarn"))
    local = _Session(None, "local[2]")
    assert os.path.isdir(shared_folder(local)) and shared_folder(local) == local.folder
    assert scratch_path(spark, "a").startswith(shared_folder(spark)) and scratch_path(spark, "a") != scratch_path(spark, "a")
    assert rows(stage(spark.range(3).toDF("a"), "x")) == [(0,), (1,), (2,)]


def test_csv_quotes_and_corrupt_lines(spark):
    path = scratch_path(spark, "csv")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(1, 'x,"y"'), (2, None), (3, "")], schema)
    sinks.write_csv(df, path)
    assert rows(readers.read_csv(spark, path, schema))[0] == (1, 'x,"y"')
    spark.createDataFrame([("a,b",), ("1,ok",), ("oops,z",)], "value string").coalesce(1).write.text(path + "t")
    got = readers.read_csv(spark, path + "t", schema, corrupt=True).collect()
    assert [(r["a"], r["_corrupt"]) for r in got] == [(1, None), (None, "oops,z")]


@pytest.mark.parametrize("split", ["134217728", "2000"])
def test_file_order_index(spark, split):
    """Positions follow file names and places in the file, however the files are split."""
    path = scratch_path(spark, "order")
    n = 5000
    spark.range(n).select(F.col("id").alias("a"), F.repeat(F.lit("x"), 20).alias("b")).repartitionByRange(3, "a") \
        .sortWithinPartitions(F.desc("a")).write.option("header", True).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = spark.read.schema("a long, b string").option("header", True).csv(path)
        got = readers.file_order_index(df, start=10).orderBy("idx").collect()
        assert split != "2000" or df.rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["idx"] for r in got] == list(range(10, n + 10))
    want = [r["a"] for r in sorted(spark.read.schema("a long, b string").option("header", True).csv(path)
            .select("a", F.col("_metadata.file_name").alias("f")).collect(), key=lambda r: (r["f"], -r["a"]))]
    assert [r["a"] for r in got] == want


def test_topic_scan(spark):
    root = scratch_path(spark, "topic")
    schema = T.StructType([T.StructField("user", T.StringType()), T.StructField("amount", T.StringType()),
                           T.StructField("is_fraud", T.StringType())])
    assert readers.read_topic(spark, root, "t", schema, ["user", "nope"]).collect() == []
    spark.createDataFrame([("u1", "Yes"), ("u2", "No")], "user string, is_fraud string") \
        .write.parquet(f"{root}/topics/t/partition=0/a")
    spark.createDataFrame([("u3", "$1", "Yes")], "user string, amount string, is_fraud string") \
        .write.parquet(f"{root}/topics/t/partition=1")
    spark.createDataFrame([("x", "Yes")], "user string, is_fraud string").write.parquet(f"{root}/topics/t/other")
    df = readers.read_topic(spark, root, "t", schema, ["amount", "user"], F.col("is_fraud") == "Yes")
    assert rows(df) == [("$1", "u3"), (None, "u1")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_fraud), EqualTo(is_fraud,Yes)]" in plan


def test_documents_and_prefixes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "sub" / "b.txt").write_text("three")
    assert sorted(r["text"] for r in readers.read_documents(spark, str(tmp_path)).collect()) == ["one\ntwo", "three"]
    path = scratch_path(spark, "prefix")
    spark.range(2).toDF("a").coalesce(1).write.parquet(path)
    got = readers.read_prefix_with_file(spark, path, spark.read.parquet(path).schema).collect()
    assert len(got) == 2 and got[0]["file_name"].endswith(".parquet") and got[0]["table"] == got[0]["file_name"].split("_")[0]


def test_union_of_different_columns(spark):
    a, b = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string")
    assert [tuple(r) for r in readers.union_all([a, b]).collect()] == [(1, None), (None, "x")]


def test_append_modes(spark):
    path = scratch_path(spark, "append")
    df = spark.createDataFrame([("u1", 3), ("u2", 1)], "user string, count_fraud long")
    for _ in range(2):
        sinks.append_table(df, path, ["count_fraud", "user"], "20240701")
    assert spark.read.parquet(path).count() == 2
    sinks.append_table(df, path, ["count_fraud", "user"], "20240701", "reference_append")
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(ValueError):
        sinks.append_table(df, path, ["user"])


def test_table_in_the_catalog(spark):
    path = scratch_path(spark, "catalog")
    report_rows = spark.createDataFrame([("u1", 3, "Ann", 30, None, "5", "$9")], schemas.FRAUD_REPORT)
    sinks.append_table(report.coerce_olap(report_rows), path, ["count_fraud", "user"], "20240701")
    for _ in range(2):
        sinks.create_table(spark, "fraud_report_test", schemas.FRAUD_REPORT, path)
    try:
        spark.sql("MSCK REPAIR TABLE fraud_report_test")
        found = questions.ask(spark, "SELECT user, count_fraud FROM fraud_report_test WHERE ds = :ds", ds="20240701")
        assert rows(found) == [("u1", 3)]
    finally:
        spark.sql("DROP TABLE fraud_report_test")


def test_csv_keeps_line_breaks(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    df = spark.createDataFrame([(1, 'a\nb "c"'), (2, "plain, text")], schema)
    sinks.write_csv(df, str(tmp_path / "t"))
    assert sorted(tuple(r) for r in readers.read_csv(spark, str(tmp_path / "t"), schema).collect()) == [(1, 'a\nb "c"'), (2, "plain, text")]


def test_empty_rerun_empties_the_date(spark, tmp_path):
    df, root = spark.range(5), str(tmp_path)
    sinks.write_stage(df.limit(0), root, "first", "20240701")
    assert readers.read_stage(spark, root, "first", "20240701", df.schema).count() == 0
    sinks.write_stage(df, root, "t", "20240701")
    sinks.write_stage(df, root, "t", "20240702")
    sinks.write_stage(df.limit(0), root, "t", "20240701")
    assert readers.read_stage(spark, root, "t", "20240701").count() == 0
    assert readers.read_stage(spark, root, "t", "20240702").count() == 5


def test_positions_do_not_depend_on_later_splits(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.range(20000).repartition(3).sortWithinPartitions("id").write.csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        out = readers.file_order_index(spark.read.schema("id long").csv(path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
        assert sorted(r["idx"] for r in out.collect()) == list(range(20000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tables_by_dataset_folder(spark):
    root = scratch_path(spark, "data sets")
    spark.range(3).write.parquet(f"{root}/card_20240701")
    spark.range(2).write.parquet(f"{root}/user.parquet")
    spark.range(4).withColumn("ds", F.lit("x")).write.partitionBy("ds").parquet(f"{root}/txn_b")
    found = readers.read_prefix_with_file(spark, root, T.StructType([T.StructField("id", T.LongType())]))
    assert rows(found.groupBy("file_name", "table").count()) == [("card_20240701", "card", 3), ("txn_b", "txn", 4), ("user.parquet", "user.parquet", 2)]


def test_sorted_tables_have_narrow_row_groups(spark):
    """Row groups hold narrow ranges of the sort key, so a filter on it skips most of them."""
    import glob
    import pyarrow.parquet as pq
    path = scratch_path(spark, "layout")
    df = spark.range(0, 40_000, 1, 8).select((F.hash("id") % 1000).alias("count_fraud"), F.concat(F.lit("u"), "id").alias("user"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so little data is one file
    try:
        sinks.append_table(df, path, ["count_fraud", "user"], "20240701")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = []
    for file in glob.glob(path.removeprefix("file:") + "/ds=20240701/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(0).statistics
            spans.append((stats.min, stats.max))
    spans.sort()
    assert len(spans) >= 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert max(b - a for a, b in spans) < 2000 / 3


def test_staged_tables_are_deleted_with_their_job(spark):
    with staged_until_done(spark):
        kept = stage(spark.range(3), "inside")
        path = kept.inputFiles()[0]
        assert os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))
    with pytest.raises(ValueError):
        shared_folder(_Session(None, "local-cluster[2,1,1024]"))
