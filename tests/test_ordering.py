import random

import pytest
from pyspark.sql import functions as F

from cardlake.operators.lookups import hot_keys, lookup, table_bytes
from cardlake.operators import lookups
from cardlake.operators.ordering import dense_index, index_within, order_ranges, running_totals


@pytest.mark.parametrize("per_range", [7, 100, 10 ** 6])
@pytest.mark.parametrize("partitions", [1, 8])
def test_dense_index(frame, per_range, partitions):
    r = random.Random(1)
    # a third of the rows share one leading key, and some have none
    data = [(None if i % 10 == 0 else "hot" if i % 3 == 0 else r.choice("abcdé") * r.randint(1, 3), i) for i in range(997)]
    r.shuffle(data)
    df = dense_index(frame(data, "k string, i long", partitions), ["k", "i"], "pos", 5, per_range)
    expected = sorted(data, key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1]))
    assert df.columns[0] == "pos"
    assert sorted(tuple(x) for x in df.collect()) == [(n + 5, *row) for n, row in enumerate(expected)]


def test_dense_index_of_nothing(spark):
    df = spark.createDataFrame([], "a long")
    assert dense_index(df, ["a"]).collect() == []


def test_ranges_split_a_hot_leading_key(frame):
    df = frame([("x", i) for i in range(4000)], "k string, i long")
    ranges = order_ranges(df, ["k", "i"], 500)
    sizes = df.groupBy(ranges.number.alias("r")).count().collect()
    assert ranges.count == 8 and len(sizes) == 8 and max(s["count"] for s in sizes) < 1000


@pytest.mark.parametrize("kind", ["double", "timestamp", "date", "decimal(12,3)"])
def test_ranges_of_other_types(spark, kind):
    base = {"double": "id * 0.37", "timestamp": "timestamp_seconds(id * 1000)", "date": "date_add(date'2020-01-01', cast(id AS int))",
            "decimal(12,3)": "cast(id * 1.125 AS decimal(12,3))"}[kind]
    df = spark.range(0, 2000, 1, 4).select(F.expr(base).alias("k"), "id")
    out = dense_index(df, ["k"], "pos", rows_per_range=100)
    assert out.where("pos <> id").count() == 0 and out.count() == 2000


@pytest.mark.parametrize("per_range", [5, 10 ** 6])
def test_running_totals(frame, per_range):
    data = [(i, (i * 7) % 5, i % 3) for i in range(200)]
    out, totals = running_totals(frame(data, "k int, a long, b long"), ["k"], ["a", "b"], per_range)
    a = b = 0
    expected = []
    for n, (k, x, y) in enumerate(data):
        a, b = a + x, b + y
        following = data[n + 1][1:] if n + 1 < len(data) else (None, None)
        expected.append((k, x, y, a, following[0], b, following[1]))
    got = sorted(tuple(r) for r in out.select("k", "a", "b", "cum_a", "next_a", "cum_b", "next_b").collect())
    assert got == expected and totals == {"a": a, "b": b}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("size", [None, 1000])
def test_lookup_with_hot_keys(frame, how, size):
    facts = frame([(i, "hot" if i % 3 == 0 else f"k{i % 40}", i % 2) for i in range(3000)], "id long, k string, x int")
    table = frame([("hot", 1), *[(f"k{i}", i) for i in range(0, 40, 2)]], "k string, v int")
    counted = facts.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counted, "k", share=0.1)
    assert hot == ["hot"]
    out = lookup(facts, table, "k", how, size, hot, ["id"])
    plain = facts.join(table, "k", how)
    assert sorted(map(tuple, out.select(plain.columns).fillna(-1).collect())) == sorted(map(tuple, plain.fillna(-1).collect()))


def test_hot_rows_are_spread_only_without_broadcast(frame, monkeypatch):
    facts = frame([(i, "hot") for i in range(100)], "id long, k string")
    table = frame([("hot", 1)], "k string, v int")
    small = lookup(facts, table, "k", size=table_bytes(table), hot=lambda: pytest.fail("no need of hot keys"))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 10)
    big = lookup(facts, table, "k", size=table_bytes(table), hot=lambda: ["hot"])
    assert "__salt" in big._jdf.queryExecution().executedPlan().toString()
    assert big.count() == 100


@pytest.mark.parametrize("per_range", [50, 10 ** 6])
def test_index_within_groups(frame, per_range):
    data = [("hot" if i % 3 else None if i % 2 else f"g{i % 5}", i) for i in range(900)]
    out = index_within(frame(data, "g string, i int"), ["g"], ["i"], "pos", per_range)
    seen = {}
    want = []
    for g, i in data:
        want.append((seen.get(g, 0), g, i))
        seen[g] = seen.get(g, 0) + 1
    assert sorted(map(tuple, out.collect()), key=lambda r: r[2]) == want


def test_index_within_hot_groups_by_shuffle(frame, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    data = [("hot" if i % 3 else f"g{i % 5}", i) for i in range(900)]
    out = index_within(frame(data, "g string, i int"), ["g"], ["i"], "pos", 100)
    seen = {}
    for r in sorted(out.collect(), key=lambda r: r["i"]):
        assert r["pos"] == seen.get(r["g"], 0)
        seen[r["g"]] = r["pos"] + 1
    assert sum(seen.values()) == 900


def test_wide_texts_stay_under_a_size_per_task(spark):
    """A few rows hold nearly all bytes; the input is evaluated once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    wide = spark.range(0, 4000, 1, 6).select("id", F.when((F.col("id") >= 1000) & (F.col("id") < 1040), F.repeat(F.lit("x"), 50_000))
                                             .otherwise("y").alias("text")).mapInArrow(count, "id long, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = dense_index(wide, ["id"], "pos", bytes_per_range=300_000)
        sizes = out.groupBy(F.spark_partition_id()).agg(F.sum(F.length("text")).alias("n")).collect()
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert out.where("pos <> id").count() == 0 and out.count() == 4000 and seen.value == 4000
    staged = spark.createDataFrame([(r["id"], 50_064 if 1000 <= r["id"] < 1040 else 65) for r in spark.range(4000).collect()], "id long, b long")
    ranges = order_ranges(staged, ["id"], size="b", bytes_per_range=300_000)
    per = staged.groupBy(ranges.number).agg(F.sum("b").alias("b")).collect()
    assert ranges.count >= 8 and max(r["b"] for r in per) <= 900_000 and "__range" in plan and sizes
