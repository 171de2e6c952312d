import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlake.operators import lookups, vectors
from cardlake.operators.collection import build_filter, insert_bucketed, may_hold, read_collection
from tests.conftest import rows


def distance(metric, q, v):
    if metric == "l2":
        return np.sqrt(((q - v) ** 2).sum())
    if metric == "ip":
        return -(q @ v)
    scale = np.sqrt(q @ q) * np.sqrt(v @ v)
    return 1.0 - (q @ v / scale if scale > 0 else 0.0)


@pytest.mark.parametrize("metric", vectors.METRICS)
@pytest.mark.parametrize("block", [2, 100])
def test_top_k(spark, metric, block):
    """A third of the vectors are copies of one, so ties go over batches and partitions; one vector is zero."""
    r = np.random.default_rng(1)
    data = r.normal(size=(300, 8))
    data[::3], data[7] = data[0], 0.0
    queries = np.vstack([data[0], r.normal(size=(4, 8))])
    collection = spark.createDataFrame([(f"id{i:03d}", [float(x) for x in v]) for i, v in enumerate(data)],
                                       "id string, embedding array<double>").repartition(7)
    asked = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(queries)],
                                  "query_id int, embedding array<double>")
    want = []
    for i, q in enumerate(queries):
        ranked = sorted((round(distance(metric, q, v), 9) + 0.0, f"id{j:03d}") for j, v in enumerate(data))[:4]
        want += [(i, n + 1, name, pytest.approx(d, abs=2e-9)) for n, (d, name) in enumerate(ranked)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = rows(vectors.top_k(asked, collection, 4, metric, max_queries=block))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want


def test_fewer_rows_than_k(spark):
    collection = spark.createDataFrame([(1, [0.0]), (2, None), (3, [2.0])], "id int, embedding array<float>")
    asked = spark.createDataFrame([(9, [1.5])], "query_id int, embedding array<double>")
    assert rows(vectors.top_k(asked, collection)) == [(9, 1, 3, 0.5), (9, 2, 1, 1.5)]
    assert vectors.top_k(asked.limit(0), collection).collect() == []


def test_width_is_checked(spark):
    collection = spark.createDataFrame([(1, [0.0, 1.0])], "id int, embedding array<float>")
    asked = spark.createDataFrame([(9, [1.5])], "query_id int, embedding array<double>")
    with pytest.raises(Exception, match="vectors of length 1"):
        vectors.top_k(asked, collection).collect()


def test_hashed_embedding(spark):
    df = spark.createDataFrame([("The fraud, the CARD",), ("",), (None,), ("?!",), ("card the FRAUD the",)], "t string")
    got = [np.array(r[0]) for r in df.coalesce(1).select(vectors.hashed_embedding(F.col("t"), 32)).collect()]
    assert all(len(v) == 32 for v in got)
    np.testing.assert_allclose(np.linalg.norm(got[0]), 1.0)
    assert all((got[i] == 0).all() for i in (1, 2, 3))
    np.testing.assert_array_equal(got[0], got[4])


def test_outside_provider(spark):
    df = spark.createDataFrame([(i, None if i == 3 else f"t{i}") for i in range(25)], "id int, text string").coalesce(1)

    def provider(texts):
        if "t12" in texts:
            raise RuntimeError("service down")
        assert len(texts) <= 10
        return [[float(len(t)), 1.0] for t in texts]

    out = {r["id"]: (r["embedding"], r["failed"]) for r in vectors.embed_with(df, provider, 2, batch=10).collect()}
    assert out[0] == ([2.0, 1.0], False) and out[3] == ([0.0, 0.0], True)
    assert [i for i, (v, failed) in out.items() if failed] == [3, *range(11, 21)]


def test_insert_new(frame):
    collection = frame([("a", "old")], "id string, document string")
    incoming = frame([("a", "new", 1), ("b", "second", 3), ("b", "first", 2)], "id string, document string, pos int")
    assert rows(vectors.insert_new(collection, incoming, "pos").select("id", "document")) == [("b", "first")]


def test_insert_batch(frame):
    incoming = frame([("x", 1, 9), ("y", 0, 9)], "raw_text string, pos int, other int")
    assert rows(vectors.insert_batch(incoming, ["raw_text"], ["pos"], 7)) == [(7, "y"), (8, "x")]


def test_retrieve(spark):
    def provider(c):
        return vectors.hashed_embedding(c, 64)
    docs = spark.createDataFrame([("d1", "fraud on card seven"), ("d2", "weather report"), ("d3", "")], "id string, document string")
    collection = docs.withColumn("embedding", provider(F.col("document")))
    asked = spark.createDataFrame([(1, "card fraud")], "query_id int, text string")
    out = vectors.retrieve(asked, collection, provider, 2, "cosine").orderBy("rank").collect()
    assert out[0]["document"] == "fraud on card seven" and len(out) == 2


def test_many_queries_in_several_passes(spark, monkeypatch):
    """More query blocks than one broadcast may hold, and no query on the driver."""
    from pyspark.sql import DataFrame
    monkeypatch.setattr(DataFrame, "toLocalIterator", None, raising=False)
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 40_000)
    collection = spark.range(500).select("id", F.array(F.col("id") * 1.0, F.lit(0.0)).alias("embedding"))
    asked = spark.range(3000).select((F.col("id")).alias("query_id"), F.array(F.col("id") / 6.0 - 0.25, F.lit(1.0)).alias("embedding"))
    got = vectors.top_k(asked, collection, 2, max_queries=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") > 2
    for r in got.where("rank = 1").collect():
        x = r["query_id"] / 6.0 - 0.25
        assert r["id"] == min(range(500), key=lambda i: (round(np.hypot(x - i, 1.0), 9), i))
    assert got.count() == 6000


def test_near_copies_keep_their_digits():
    """Distances far below what a matrix product can tell."""
    r = np.random.default_rng(4)
    base = r.normal(size=32) * 1e3
    v = np.vstack([base + r.normal(size=32) * 1e-7 for _ in range(50)] + [r.normal(size=(50, 32)) * 1e3])
    (near, d), = vectors.block_distances(base[None, :], v, "l2", 4)
    true = np.sqrt(((v - base) ** 2).sum(axis=1))
    want = np.argsort(true)[:4]
    assert set(want) <= set(near.tolist())
    np.testing.assert_allclose(d[[near.tolist().index(i) for i in want]], true[want], rtol=1e-12)


def test_bucketed_collection(spark, tmp_path):
    path = str(tmp_path / "c")
    def batch(a, b, text):
        return spark.range(a, b).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(text).alias("document"))
    assert insert_bucketed(path, batch(0, 5000, "old"), buckets=64) == []
    assert read_collection(spark, path).count() == 5000
    read = insert_bucketed(path, batch(5000, 5200, "new"))
    assert len(read) <= 6  # only where a filter could not tell
    again = insert_bucketed(path, batch(4990, 5210, "late").unionByName(batch(5209, 5212, "copy")))
    assert len(again) <= 64
    got = {r["id"]: r["document"] for r in read_collection(spark, path).collect()}
    assert read_collection(spark, path).count() == 5212 == len(got)
    assert (got["k4995"], got["k5100"], got["k5205"], got["k5211"]) == ("old", "new", "late", "copy")
    order = spark.createDataFrame([("x", "second", 2), ("x", "first", 1), (None, "nobody", 0), ("k1", "there", 0)], "id string, document string, pos int")
    insert_bucketed(path, order, "pos")
    assert rows(read_collection(spark, path).where("id IN ('x', 'k1') OR id IS NULL").select("id", "document")) == [("k1", "old"), ("x", "first")]
    assert insert_bucketed(path, order.limit(0), "pos") == []


def test_filters_miss_nothing():
    r = np.random.default_rng(0)
    held, others = (r.integers(0, 2**63, 20000, dtype=np.uint64) for _ in range(2))
    known = build_filter(held)
    assert may_hold(known, held).all() and may_hold(known, others).mean() < 0.01 and len(known) == 20000 * 16 // 8


def test_insert_after_a_broken_one(spark, tmp_path):
    """Filters without their rows only cost a look."""
    path = str(tmp_path / "c")
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("document"))
    insert_bucketed(path, df.where("id < '5'"), buckets=4)
    import shutil
    lost = sorted((tmp_path / "c" / "rows").glob("bucket=*"))[0]
    shutil.move(lost, tmp_path / "aside")
    insert_bucketed(path, df, buckets=4)
    assert rows(read_collection(spark, path).select("id")) == rows(df.select("id"))
