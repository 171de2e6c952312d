import io

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardlake.functions import text as tx
from cardlake.operators import text, vectors
from cardlake.plans import indexing, text_queries
from cardlake.session import scratch_path
from tests.conftest import rows


def cut(s, size, overlap):
    step = size - overlap
    return [s[i:i + size] for i in range(0, len(s), step)]


@pytest.mark.parametrize("n, lengths", [
    (0, []), (1, [1]), (250, [250]), (251, [251, 1]), (300, [300, 50]), (301, [300, 51]), (500, [300, 250]),
    (501, [300, 251, 1]), (760, [300, 300, 260, 10])])
def test_chunk_lengths(spark, n, lengths):
    df = spark.createDataFrame([("x" * n,)], "text string")
    assert [len(c) for c in df.select(tx.chunks(F.col("text"))).first()[0]] == lengths


@pytest.mark.parametrize("size, overlap", [(300, 50), (10, 0), (10, 7), (10, 9), (1, 0)])
def test_chunks_of_any_text(spark, size, overlap):
    texts = ["", "a\nb\r\n" * 40, "äöü😀é" * 61, "x" * 10, "日本語テキスト" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for r in text.chunk(df, size=size, overlap=overlap).orderBy("id", "chunk_no").collect():
        got.setdefault(r["id"], []).append(r["chunk"])
    assert got == {i: cut(t, size, overlap) for i, t in enumerate(texts) if t}


def test_chunks_of_null_and_bad_sizes(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert text.chunk(df).collect() == []
    with pytest.raises(ValueError):
        tx.chunks(F.col("text"), 10, 10)


def test_long_text_takes_linear_time(spark):
    n = 2_000_000
    df = spark.range(1).select(F.repeat(F.lit("abcdefghij"), n // 10).alias("text"))
    assert text.chunk(df).count() == n // 250


ODD = [(1, "x,y", None, 'q"q'), (2, "", "line\nbreak", " z "), (3, None, None, "'"), (4, "é;", "a\rb", "1.5")]


def test_csv_equals_pandas(spark):
    names = ["a", "b c", 'd"e', "f"]
    df = spark.createDataFrame(ODD, "a int, b string, c string, d string").toDF(*names)
    frame = pd.DataFrame(ODD, columns=names).replace({"": None})
    want = frame.to_csv(index=False)
    lines = [r[0] for r in df.orderBy("a").select(tx.csv_line(names)).collect()]
    assert tx.csv_header(names) + "\n" + "\n".join(lines) + "\n" == want


def test_one_column_csv(spark):
    df = spark.createDataFrame([("x",), (None,)], "a string")
    want = pd.DataFrame({"a": ["x", None]}).to_csv(index=False)
    assert "a\n" + "\n".join(r[0] for r in df.select(tx.csv_line(["a"])).collect()) + "\n" == want


@pytest.mark.parametrize("n", [0, 3, 400, 3000])
def test_table_documents(frame, n):
    data = [(i, None if i % 3 else f"v{i}", i % 2) for i in range(n)] + [(0, "only", 1)]
    names = ["short_1.parquet" if i == n else "long_2.parquet" for i in range(n + 1)]
    df = frame([(*d, name, i) for i, (d, name) in enumerate(zip(data, names))],
               "a int, b string, c int, file_name string, pos long")
    got = {r["file_name"]: r for r in text.table_documents(df, ["a", "b", "c"]).collect()}
    buffer = io.StringIO()
    pd.DataFrame(data[:n], columns=["a", "b", "c"]).to_csv(buffer, index=False)
    if n:
        long = got["long_2.parquet"]
        assert (long["table"], long["row_count"], long["columns"]) == ("long", n, "a,b,c")
        assert long["text"] == buffer.getvalue()[:1500]
    assert got["short_1.parquet"]["text"] == "a,b,c\n0,only,1\n"
    assert len(got) == (2 if n else 1)


def test_pick_text(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), (None, " \t"), (" ", "x"), (None, None)], "content string, message string")
    assert [r["text"] for r in text.pick_text(df).collect()] == ["a", "b"]
    assert text.pick_text(df.select("content")).count() == 1


def test_batches(frame):
    out = text.batch_no(frame([(i,) for i in range(250)], "id int"), ["id"])
    assert rows(out.groupBy("batch_no").count()) == [(0, 100), (1, 100), (2, 50)]


def test_batches_per_file(frame):
    out = text.batch_no(frame([(f"f{i % 2}", i) for i in range(301)], "file string, i int"), ["i"], by=["file"])
    assert rows(out.groupBy("file", "batch_no").count()) == [
        ("f0", 0, 100), ("f0", 1, 51), ("f1", 0, 100), ("f1", 1, 50)]
    assert out.where("file = 'f1' AND i = 3").first()["pos"] == 1


def test_index_of_a_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x" * 301)
    (tmp_path / "b.txt").write_text("fraud")
    path = scratch_path(spark, "folder")
    for _ in range(2):
        indexing.index_documents(spark, str(tmp_path), path, lambda c: vectors.hashed_embedding(c, 8))
    found = spark.read.parquet(path)
    assert sorted(len(r["document"]) for r in found.collect()) == [5, 51, 300]


def test_staged_files_grow_in_number_with_the_table(spark, monkeypatch):
    df = spark.createDataFrame([(i * 7 % 100, "x" * 1000) for i in range(100)], "key long, text string")
    monkeypatch.setattr(text_queries, "_FILE_BYTES", 10_000)  # the rows take some 110,000
    path = scratch_path(spark, "ordered")
    text_queries._write_ordered(df, "key", path)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("key").alias("low"), F.count("*").alias("n"))
    found = files.orderBy("file").collect()
    assert len(found) > 8 and max(r["n"] for r in found) < 25 and sum(r["n"] for r in found) == 100
    assert [r["low"] for r in found] == sorted(r["low"] for r in found)
