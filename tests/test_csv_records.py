"""CSV with line breaks inside quotes, read in many splits, against Python's own reader."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import types as T

from cardlake.session import scratch_path
from cardlake.sources import csv_records, readers
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])


def write_files(folder, files):
    os.makedirs(folder)
    for i, text in enumerate(files):
        with open(f"{folder}/part-{i}.csv", "w", newline="") as f:
            f.write(text)


def random_rows(pick, n):
    word = lambda: pick.choice(["plain", 'say "hi"', "a,b", "two\nlines", "\n", '"', '""', "x\r\ny", "é" * 9, "long " * 80, "\n\n\n\"\n,", "end\n", "no quote for long\n" * 9])
    return [(i, word(), pick.choice([word(), None])) for i in range(n)]


def as_text(table, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["a", "b", "c"])
    writer.writerows(table)
    return out.getvalue()


@pytest.fixture
def small_splits(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield use
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


@pytest.mark.parametrize("size", ["61", "211", "5000", "134217728"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_split_size_gives_the_rows(spark, small_splits, tmp_path, size, end):
    pick = random.Random(3)
    tables = [random_rows(pick, n) for n in (30, 0, 1, 12)]
    write_files(tmp_path / "t", [as_text(t, end) for t in tables])
    small_splits(size)
    got = readers.read_csv(spark, str(tmp_path / "t"), SCHEMA, index="at")
    want = [r for t in tables for r in t]
    assert [tuple(r)[1:] for r in got.orderBy("at").collect()] == [(a, b, c) for a, b, c in want]
    assert [r["at"] for r in got.orderBy("at").collect()] == list(range(len(want)))
    if size == "211":
        assert csv_records.read_lines(spark.read, str(tmp_path / "t")).rdd.getNumPartitions() > 12


def test_states_of_either_start():
    assert [csv_records.ends_inside(t, False) for t in ('a,b', 'a,"b', 'a,"b"', '"a""', '"a"",', 'x"y,z', 'x"y,"z', '"a"b"c,"d', '')] == \
        [False, True, False, True, True, False, True, True, False]
    assert [csv_records.ends_inside(t, True) for t in ('a', 'a"', 'a""', 'a","b', 'a",b', '"', '",""', '"x"y,"')] == \
        [True, False, True, True, False, False, False, True]


def test_stray_and_unclosed_quotes(spark, small_splits, tmp_path):
    """A quote inside an unquoted field is text; an unclosed one takes in the rest of its own file only."""
    write_files(tmp_path / "t", ['a,b,c\n1,x"y,z\n2,"p\nq",r\n3,5",6"\n4,"open\n5,not,a row\n', "a,b,c\n7,u,v\n"])
    small_splits("9")
    got = rows(readers.read_csv(spark, str(tmp_path / "t"), SCHEMA))
    assert [(r[0], r[1]) for r in got] == [(1, 'x"y'), (2, "p\nq"), (3, '5"'), (4, "open\n5,not,a row"), (7, "u")]


def test_corrupt_records_and_no_breaks(spark, small_splits, tmp_path):
    write_files(tmp_path / "t", ['a,b,c\n1,"x\ny",z\noops,"p\nq",r\n'])
    small_splits("11")
    got = rows(readers.read_csv(spark, str(tmp_path / "t"), SCHEMA, corrupt=True))
    assert {(r[0], r[1], r[3]) for r in got} == {(1, "x\ny", None), (None, "p\nq", 'oops,"p\nq",r')}
    write_files(tmp_path / "n", ['a,b,c\n1,"x, y",z\n', "a,b,c\n", ""])
    plain = readers.read_csv(spark, str(tmp_path / "n"), SCHEMA)
    assert rows(plain) == [(1, "x, y", "z")] and "FileScan csv" in plain._jdf.queryExecution().toString()


def test_shuffled_states(spark, small_splits, tmp_path, monkeypatch):
    """More splits than a broadcast may hold."""
    monkeypatch.setattr(csv_records, "BROADCAST_BYTES", 0)
    table = random_rows(random.Random(8), 40)
    write_files(tmp_path / "t", [as_text(table)])
    small_splits("50")
    assert rows(readers.read_csv(spark, str(tmp_path / "t"), SCHEMA)) == sorted(table, key=lambda r: r[0])


def test_stream(spark, small_splits, tmp_path):
    tables = [random_rows(random.Random(i), 30) for i in range(3)]
    write_files(tmp_path / "t", [as_text(t) for t in tables])
    small_splits("300")
    batches = []
    root = scratch_path(spark, "csv-stream")

    def write(df, number):
        batches.append(sorted(tuple(r) for r in df.select("a", "b").collect()))

    csv_records.stream_csv(spark, str(tmp_path / "t"), SCHEMA, write, f"{root}/checkpoint").awaitTermination()
    assert sorted(batches) == sorted(sorted((a, b) for a, b, _ in t) for t in tables)
