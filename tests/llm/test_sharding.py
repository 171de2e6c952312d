"""Histogram-sorted shards: whole rows, gapless slots, bytes near the target, copies together."""

import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cardlake.llm import sharding as S
from cardlake.llm.queries import QUERIES
from cardlake.session import scratch_path


def check(rows, texts, shards, tolerance):
    """``texts``: (id, text) of the input; ``rows``: the result. Returns bytes per shard."""
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots, size = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    mean, largest = sum(size.values()) / shards, max(r["size"] for r in rows)
    assert all(abs(size[s] - mean) <= 2 * tolerance * mean + largest + 1 for s in range(shards))
    homes = defaultdict(set)
    for r in rows:
        homes[r["text_crc32"], r["size"]].add(r["shard"])
    group = Counter()
    for r in rows:
        group[r["text_crc32"], r["size"]] += r["size"]
    for key, home in homes.items():
        assert len(home) == max(home) - min(home) + 1, "copies stand in neighbouring shards"
        assert len(home) == 1 or group[key] > tolerance * mean, "small groups stay whole"
    return size


def test_hot_group_and_odd_rows(spark):
    pick = random.Random(2)
    texts = [(i, "copy of one text " * 3) for i in range(3000)]
    texts += [(5000 + i, "é" * pick.randrange(1, 300)) for i in range(4000)] + [(None, None), (None, ""), (1, "x"), (1, "x"), (9, "long " * 200000)]
    texts += [(7, "same row")] * 2000
    pick.shuffle(texts)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(7).withColumn("size", F.lit("x")).withColumn("h", F.lit(1))
    got = S.shard_documents(df.filter("doc_id <> 9 or doc_id is null"), range_rows=200).collect()
    size = check(got, [t for t in texts if t[0] != 9], 16, S.TOLERANCE)
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 16
    whole = S.shard_documents(df, range_rows=200)  # one text is larger than a shard
    assert Counter(r["doc_id"] for r in whole.collect()) == Counter(i for i, _ in texts)


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "doc_id long, text string")
    rows = S.shard_documents(df).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2, 3] and len({(r["shard"], r["slot"]) for r in rows}) == 3
    assert S.shard_documents(df.limit(0)).collect() == []


def test_splitters_match_a_plain_sort(spark):
    pick = random.Random(4)
    rows = [(pick.choice([-2**63, 2**63 - 1, 0, 5, pick.randrange(-2**63, 2**63)]), r, pick.randrange(1, 50)) for r in range(5000)]
    keys = spark.createDataFrame(rows, "h long, r long, size long").repartition(5)
    cuts = S.find_splitters(keys, 8, 1 / 1000, 500)
    places = list(zip(cuts.hashes.tolist(), cuts.numbers.tolist()))
    assert cuts.rows_below == [0] + [sum((h, r) < p for h, r, _ in rows) for p in places]
    total, size = sum(s for *_, s in rows), Counter()
    for h, r, s in rows:
        size[cuts.shard[sum(p <= (h, r) for p in places)]] += s
    assert all(abs(size[i] - total / 8) <= 2 * total / 8 / 1000 + 50 for i in range(8))


def test_written_shards(spark):
    df = spark.createDataFrame([(i, f"text {i} " * (i % 40)) for i in range(500)], "doc_id long, text string").repartition(4)
    path = scratch_path(spark, "shards")
    S.write_shards(S.shard_documents(df, keep=("doc_id", "text"), shards=4), path)
    back = spark.read.parquet(path)
    assert {(r["doc_id"], r["text"]) for r in back.collect()} == {(r["doc_id"], r["text"]) for r in df.collect()}
    assert back.select("shard").distinct().count() == 4


def test_registered_query(spark):
    path = "/root/testdata/sf0.001"
    rows = QUERIES["op12_histogram_sort"](spark, path).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, texts, 16, S.TOLERANCE)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
