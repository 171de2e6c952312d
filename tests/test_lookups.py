"""Joins against a table that is too large to broadcast: hot keys are counted in the rows to be joined."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardlake.operators import features, graph, lookups
from tests.conftest import rows


@pytest.fixture
def shuffled(spark, monkeypatch):
    """Nothing is broadcast, and no partition is merged with another."""
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "50"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def facts(spark, n=20_000):
    """Half of the rows ask for a merchant that no table knows, a quarter for none."""
    key = F.when(F.col("id") % 2 == 0, "ghost").when(F.col("id") % 4 == 1, F.lit(None)).otherwise(F.concat(F.lit("m"), F.col("id") % 97))
    return spark.range(n).select(F.col("id").alias("idx"), key.alias("merchant"))


def most_in_a_task(df):
    return max(r[1] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_heavy_keys_are_found_on_the_fact_side(spark):
    df = facts(spark).repartition(7)
    assert lookups.heavy_keys(df, {"m": F.col("merchant")}, 0.1) == {"m": ["ghost"]}
    every = lookups.heavy_keys(df, {"m": F.col("merchant"), "i": F.col("idx")}, 1 / 500)
    assert set(every["m"]) == {"ghost", *[f"m{i}" for i in range(97)]} and every["i"] == []
    assert lookups.heavy_keys(df.limit(0), {"m": F.col("merchant")}) == {"m": []}
    # many distinct keys beside one that holds a hundredth
    wide = spark.range(300_000).select(F.when(F.col("id") % 100 == 0, -1).otherwise(F.col("id")).alias("k")).repartition(9)
    assert lookups.heavy_keys(wide, {"k": F.col("k")}) == {"k": [-1]}


def test_unknown_hot_key_and_nulls_spread(spark, shuffled):
    df = facts(spark)
    table = spark.range(97).select(F.concat(F.lit("m"), "id").alias("merchant"), F.col("id").alias("code"))
    joined = lookups.lookup(df, table, "merchant")
    assert most_in_a_task(joined) < 20_000 / 8
    assert most_in_a_task(df.join(table, "merchant", "left")) > 20_000 / 3
    assert "__salt" in joined._jdf.queryExecution().executedPlan().toString()
    want = Counter((None if i % 4 == 1 else "ghost" if i % 2 == 0 else f"m{i % 97}", None if i % 2 == 0 or i % 4 == 1 else i % 97)
                   for i in range(20_000))
    assert Counter((r["merchant"], r["code"]) for r in joined.collect()) == want
    inner = lookups.lookup(df, table, "merchant", "inner")
    assert Counter((r["merchant"], r["code"]) for r in inner.collect()) == {k: v for k, v in want.items() if k[1] is not None}


def test_codes_and_nodes_of_unknown_hot_values(spark, shuffled):
    df = facts(spark).withColumn("city", F.col("merchant"))
    known = df.where("merchant <> 'ghost'")
    codes = features.fit_label_codes(known, ["merchant", "city"])
    coded = features.apply_label_codes(df, codes, unseen="zero", falsy_zero=True, spread=["idx"])
    assert most_in_a_task(coded) < 20_000 / 8
    assert {r[0] for r in coded.where("idx % 4 < 3").select("merchant").distinct().collect()} == {0}
    nodes = graph.bipartite_nodes(known.withColumn("card_id", F.lit("c1")), merchant="merchant", order="idx")
    found = graph.resolve_edges(df.withColumn("card_id", F.lit("c1")), nodes, merchant="merchant", default=0, spread=["idx"])
    assert most_in_a_task(found) < 20_000 / 8
    assert rows(found.groupBy("src_known", "dst_known").count()) == [(True, False, 15_000), (True, True, 5_000)]
