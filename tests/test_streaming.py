import json

from pyspark.sql import functions as F

from cardlake import schemas
from cardlake.plans import daily_report
from cardlake.session import scratch_path
from cardlake.sources import adapters, readers, sinks
from cardlake.streaming import ingest, leases, scoring, topics
from tests.conftest import SMALL, rows

TXN = topics.TOPICS["transaction-topic"]


def test_layout(spark):
    assert {t.name: (t.partitions, t.key, t.table) for t in topics.TOPICS.values()} == {
        "transaction-topic": (4, "user", "transaction_topic"), "user-topic": (2, "idx", "user_topic"),
        "card-topic": (3, "user", "card_topic")}
    df = adapters.transactions(spark, SMALL)
    records = topics.to_topic(df, TXN)
    assert records.where("partition < 0 OR partition > 3").count() == 0
    assert records.groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0
    assert topics.topic_layout(df, TXN).select("partition").distinct().count() == 4


def filled(df, schema):
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def test_ingest_to_both_sinks_and_restart(spark):
    root = scratch_path(spark, "ingest")
    sides = {"transaction-topic": adapters.transactions(spark, SMALL), "card-topic": adapters.cards(spark, SMALL),
             "user-topic": adapters.users(spark, SMALL)}

    def publish(part):
        for name, df in sides.items():
            topic = topics.TOPICS[name]
            topics.publish(filled(df.where(F.pmod("idx", F.lit(2)) == part), topic.schema), topic, f"{root}/source")

    def run():
        for q in ingest.run_ingest(spark, f"{root}/source", f"{root}/bronze", f"{root}/tables", f"{root}/checkpoints"):
            q.awaitTermination()

    publish(0)
    run()
    run()  # nothing new
    publish(1)
    run()
    for name, df in sides.items():
        topic = topics.TOPICS[name]
        want = rows(filled(df, topic.schema))
        assert rows(readers.read_topic(spark, f"{root}/bronze", name, topic.schema)) == want
        assert rows(spark.read.parquet(f"{root}/tables/{topic.table}").drop("batch_id")) == want
    largest = readers.read_topic(spark, f"{root}/bronze", "card-topic", schemas.CARD) \
        .groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest <= 1000

    for _ in range(2):
        daily_report.run(spark, f"{root}/bronze", f"{root}/report", "20240701", stage_root=f"{root}/stage")
    kept = spark.read.parquet(f"{root}/report")
    assert kept.count() == sides["transaction-topic"].where("is_fraud = 'Yes'").select("user").distinct().count()


SAMPLE = {"user": "user31", "card": "card2", "year": "2021", "month": "11", "day": "3", "time": "17:45", "amount": "83",
          "use_chip": "Online Transaction", "merchant_name": "4711000123456789012", "merchant_city": "Springfield",
          "merchant_state": "IL", "zip": "62701.0", "mcc": "5411"}


def test_requests(spark):
    texts = [json.dumps(SAMPLE), json.dumps({**SAMPLE, "mcc": 5411, "merchant_name": 4711000123456789012}),
             json.dumps({**SAMPLE, "mcc": None}), '{"user": "u', None, json.dumps({**SAMPLE, "month": "May"})]
    out = scoring.parse_requests(spark.createDataFrame([(t,) for t in texts], "value string"))
    valid = out.valid.collect()
    assert len(valid) == 2 and valid[0] == valid[1]
    assert (valid[0]["merchant_name"], valid[0]["zip"], valid[0]["mcc"], valid[0]["errors"]) == \
        (4711000123456789012, 62701.0, 5411, None)
    assert sorted(r["reasons"][0] for r in out.rejects.collect()) == ["mcc: null", "month: not int", "not JSON", "not JSON"]


def test_alert_text(spark):
    row = spark.createDataFrame([("user88", "card1", 2019, 12, 9, "23:07", "$64.10", None, 1, "Yes"),
                                 ("user89", "card0", 2019, 12, 9, "0:45", "$2", 7, 2, "No")],
                                "user string, card string, year int, month int, day int, time string, amount string, "
                                "merchant_name long, idx int, is_fraud string")
    assert [r["message"] for r in scoring.alerts(row).collect()] == [
        "*FRAUD DETECTED!*\nUser: user88\nCard: card1\nAmount: $64.10\nTime: 2019-12-09 23:07\nMerchant: None"]


def test_scoring_stream(spark):
    """Two batches and a restart: ids go on from the greatest in use, and a repeated batch leaves the same rows."""
    root = scratch_path(spark, "scoring")

    def send(name, requests):
        spark.createDataFrame([(json.dumps(r),) for r in requests], "value string").write.text(f"{root}/in/{name}")

    def scorer(df):
        return df.withColumn("prediction", F.when(F.col("amount") > "5", "Yes").otherwise("No"))

    def run():
        messages = spark.readStream.schema("value string").option("recursiveFileLookup", True).text(f"{root}/in")
        scoring.score_stream(messages, scorer, f"{root}/out", f"{root}/checkpoint", topic_root=f"{root}/topic") \
            .awaitTermination()

    send("none", [{"user": "nobody"}])
    run()  # a batch of rejects only
    send("a", [{**SAMPLE, "amount": a} for a in ("1", "9")] + [{"user": "only"}])
    run()
    run()
    first = rows(spark.read.parquet(f"{root}/out/transactions").select("idx", "amount", "is_fraud", "scored"))
    assert first == [(26_000_001, "1", "No", True), (26_000_002, "9", "Yes", True)]
    send("b", [{**SAMPLE, "amount": "7"}])
    run()
    every = rows(spark.read.parquet(f"{root}/out/transactions").select("idx", "amount", "is_fraud"))
    assert every[2] == (26_000_003, "7", "Yes")
    assert spark.read.parquet(f"{root}/out/alerts").count() == 2
    assert spark.read.parquet(f"{root}/out/rejects").count() == 2
    records = spark.read.schema(topics.record_schema(TXN)).parquet(f"{root}/topic/topics/{TXN.name}")
    assert rows(records.select("value.idx", "key")) == [(26_000_001, "user31"), (26_000_002, "user31"), (26_000_003, "user31")]


def test_second_checkpoint_adds_to_the_root(spark):
    root = scratch_path(spark, "two-streams")
    spark.createDataFrame([(json.dumps({**SAMPLE, "amount": a}),) for a in ("1", "9")], "value string") \
        .coalesce(1).write.text(f"{root}/in")
    for checkpoint in ("a", "b"):
        messages = spark.readStream.schema("value string").text(f"{root}/in")
        scoring.score_stream(messages, lambda df: df.withColumn("prediction", F.lit("Yes")), f"{root}/out",
                             f"{root}/{checkpoint}").awaitTermination()
    every = rows(spark.read.parquet(f"{root}/out/transactions").select("idx", "amount"))
    assert every == [(26_000_001, "1"), (26_000_002, "9"), (26_000_003, "1"), (26_000_004, "9")]


def write_requests(spark, path, amounts):
    spark.createDataFrame([(json.dumps({**SAMPLE, "amount": a}),) for a in amounts], "value string").repartition(3).write.text(path)


def test_leased_ids_of_streams_at_once(spark):
    """Three streams on one root at the same time, several batches each: no id twice."""
    root, streams = scratch_path(spark, "leased"), []
    for s in "abc":
        for part in range(2):
            write_requests(spark, f"{root}/in-{s}/{part}", [f"{s}{part}{i}" for i in range(20)])
        messages = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).option("recursiveFileLookup", True).text(f"{root}/in-{s}")
        streams.append(scoring.score_stream(messages, lambda df: df.withColumn("prediction", F.lit("No")), f"{root}/out",
                                            f"{root}/checkpoint-{s}", ids="leased"))
    for q in streams:
        q.awaitTermination()
    every = spark.read.parquet(f"{root}/out/transactions")
    assert every.count() == 120 and every.select("idx").distinct().count() == 120
    assert every.select("amount").distinct().count() == 120
    assert every.agg(F.min("idx")).first()[0] >= 26_000_001


def test_leases(spark, monkeypatch):
    root = scratch_path(spark, "leases")
    assert leases.claim(spark, f"{root}/x") and not leases.claim(spark, f"{root}/x")
    assert leases.lease_blocks(spark, root, "b0", 2, 10) == [26_000_001, 26_000_011]
    assert leases.lease_blocks(spark, root, "b0", 2, 10) == [26_000_001, 26_000_011]  # a repeated batch finds its own
    assert leases.lease_blocks(spark, root, "b1", 1, 10) == [26_000_021]
    df = spark.range(25).select(F.col("id").alias("v")).repartition(4)
    got = [[], [], []]
    for i, key in enumerate(("k0", "k1", "k2")):
        got[i] = sorted(r["idx"] for r in leases.number_rows(df if i < 2 else df.limit(0), root, key, f"k{i - 1}" if i else None, 10).collect())
    assert got[0] == list(range(26_000_031, 26_000_056)) and got[2] == []
    assert got[1][:5] == list(range(26_000_056, 26_000_061)) and len(set(got[0] + got[1])) == 50
    import pytest
    with pytest.raises(ValueError, match="not allowed"):
        leases.lease_blocks(spark, scratch_path(spark, "leases"), "b", 2, 900_000_000)


def test_repeated_batch_publishes_once(spark, tmp_path):
    """A batch that is run again, after its rows went to the topic but before the stream knew, adds no copy."""
    root = scratch_path(spark, "publish")
    write_requests(spark, f"{root}/in", [str(i) for i in range(30)])

    def run():
        messages = spark.readStream.schema("value string").text(f"{root}/in")
        scoring.score_stream(messages, lambda df: df.withColumn("prediction", F.lit("Yes")), f"{root}/out", f"{root}/checkpoint",
                             topic_root=f"{root}/topic").awaitTermination()

    run()
    fs, commit = sinks._folder(spark, f"{root}/checkpoint/commits/0")
    assert fs.delete(commit, False)
    run()
    records = readers.read_topic(spark, f"{root}/topic", TXN.name, topics.record_schema(TXN), ["value"])
    assert records.count() == 30 == records.select("value.idx").distinct().count()
    assert spark.read.parquet(f"{root}/out/transactions").count() == 30
    # moved half way: the files that are there stay, the others follow
    df = filled(adapters.transactions(spark, SMALL), TXN.schema)
    topics.publish_batch(df, TXN, f"{root}/half", "k")
    base, mark = f"{root}/half/topics/{TXN.name}", sinks._folder(spark, f"{root}/half/published/{TXN.name}/k")[1]
    fs.delete(mark, True)
    fs.delete(sinks._folder(spark, f"{base}/partition=2")[1], True)
    topics.publish_batch(df, TXN, f"{root}/half", "k")
    assert rows(spark.read.schema(topics.record_schema(TXN)).parquet(base).select("value.idx")) == rows(df.select("idx"))


def test_report_without_scored_rows(spark):
    root = scratch_path(spark, "exclude")
    txn = filled(adapters.transactions(spark, SMALL), TXN.schema)
    scored = txn.where("idx < 500").withColumn("idx", (F.col("idx") + 26_000_001).cast("int")).withColumn("is_fraud", F.lit("Yes"))

    def bronze(df, name):
        topic = topics.TOPICS[name]
        topics.topic_layout(filled(df, topic.schema), topic).write.mode("append").partitionBy("partition").parquet(f"{root}/topics/{name}")

    bronze(txn, "transaction-topic")
    bronze(adapters.cards(spark, SMALL), "card-topic")
    bronze(adapters.users(spark, SMALL), "user-topic")
    before = rows(daily_report.build_report(spark, root))
    bronze(scored, "transaction-topic")
    assert rows(daily_report.build_report(spark, root, exclude_scored=True)) == before != rows(daily_report.build_report(spark, root))
    daily_report.run(spark, root, f"{root}/table", "20240701", exclude_scored=True)
    assert spark.read.parquet(f"{root}/table").count() == len(before)


def test_repeated_batch_replaces_itself(spark):
    path = scratch_path(spark, "batch")
    df = spark.range(3)
    for batch in (0, 1, 1):
        sinks.write_batch(df, path, batch)
    assert spark.read.parquet(path).count() == 6


def test_ids_end(spark):
    import pytest
    with pytest.raises(Exception, match="are not allowed"):
        scoring.assign_idx(spark.range(5).toDF("a"), ["a"], 10 ** 9 - 2).collect()


def test_retention(spark):
    root = scratch_path(spark, "retention")
    df = filled(adapters.transactions(spark, SMALL), TXN.schema)
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    for age in (1, 6, 8):
        topics.publish(df, TXN, f"{root}/a", now - F.expr(f"INTERVAL {age} DAYS"))
    topics.compact(spark, TXN, f"{root}/a", f"{root}/b", now)
    kept = spark.read.schema(topics.record_schema(TXN)).parquet(f"{root}/b/topics/{TXN.name}")
    assert kept.count() == 2 * df.count()


def test_a_request_is_parsed_once(spark):
    """What makes a batch's messages runs once, for scores and rejects together."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    root = scratch_path(spark, "once")
    spark.createDataFrame([(t,) for t in ["no JSON", None, "{}"]], "value string").write.parquet(f"{root}/in")
    messages = spark.readStream.schema("value string").parquet(f"{root}/in").mapInArrow(count, "value string")
    scoring.score_stream(messages, lambda r: r.withColumn("prediction", F.lit("No")), f"{root}/out", f"{root}/checkpoint", ids="leased").awaitTermination()
    assert spark.read.parquet(f"{root}/out/rejects").count() == 3
    assert read.value == 3
