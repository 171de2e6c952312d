import pytest
from pyspark.sql import functions as F

from cardlake.operators import features, model, sampling
from cardlake.session import scratch_path
from cardlake.sources import adapters
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def transactions(spark):
    """Fraud depends on the amount, so that there is something to learn."""
    txn = adapters.transactions(spark, SMALL)
    amount = F.regexp_replace("amount", "[$]", "").cast("double")
    return txn.withColumn("is_fraud", F.when(amount > 60, "Yes").otherwise("No"))


@pytest.fixture(scope="module")
def trained(spark, transactions):
    split = sampling.stratified_split(features.prepare(transactions), "label")
    return model.train_edge_classifier(split, "logistic", iterations=30)


def test_training(trained):
    _, scored = trained
    by_split = {r["split"]: r for r in model.split_metrics(scored).collect()}
    assert by_split["train"]["n"] + by_split["test"]["n"] == scored.count()
    assert by_split["test"]["accuracy"] > 0.9 and by_split["test"]["loss"] < 0.4
    quality = model.quality(scored).first()
    assert quality["roc_auc"] > 0.95 and 0 < quality["average_precision"] <= 1


@pytest.mark.parametrize("kind", ["mlp", "gbt"])
def test_other_classifiers(transactions, kind):
    split = sampling.stratified_split(features.prepare(transactions), "label")
    _, scored = model.train_edge_classifier(split, kind, fit_on="all", iterations=5)
    assert scored.where("prob1 < 0 OR prob1 > 1 OR prob1 IS NULL").count() == 0


def test_saved_model_scores_the_same(spark, trained, transactions):
    fitted, scored = trained
    path = scratch_path(spark, "saved")
    model.save(fitted, path)
    again = model.score(transactions, model.load(spark, path), fill_errors=True).select("idx", F.col("prob1").alias("p"), "src_known")
    joined = scored.select("idx", "prob1").join(again, "idx")
    assert joined.count() == scored.count() and joined.where("abs(p - prob1) > 1e-9 OR NOT src_known").count() == 0


def test_unknown_nodes_and_values(spark, trained, transactions):
    fitted, _ = trained
    odd = transactions.limit(3).withColumns({"user": F.lit("nobody"), "merchant_name": F.lit(None).cast("long"),
                                             "merchant_city": F.lit("nowhere")})
    out = model.score(odd, fitted).collect()
    assert len(out) == 3 and not any(r["src_known"] or r["dst_known"] for r in out)
    with pytest.raises(Exception, match="no code for merchant_city: nowhere"):
        model.score(odd, fitted, unseen="error").collect()


def test_a_missing_merchant_is_the_least_one(trained, transactions):
    fitted, _ = trained
    two = transactions.limit(2)
    least = model.score(two.withColumn("merchant_name", F.lit(0).cast("long")), fitted).collect()
    names = [int(r[0]) for r in fitted.nodes.where("type = 'merchant'").select("key").collect()]
    none = model.score(two.withColumn("merchant_name", F.lit(None).cast("long")), fitted).collect()
    named = model.score(two.withColumn("merchant_name", F.lit(min(names)).cast("long")), fitted).collect()
    assert [r["prob1"] for r in none] == [r["prob1"] for r in named] == [r["prob1"] for r in least]
    assert not any(r["dst_known"] for r in none)


def test_versions_and_stream_scores(spark, trained, transactions):
    """A stream scores with the last stored version; probabilities stand beside the transactions and equal those of a batch."""
    import json
    from cardlake.streaming import scoring
    fitted, _ = trained
    root = scratch_path(spark, "versions")
    assert model.latest_version(spark, root) is None
    with pytest.raises(ValueError, match="no model"):
        model.ModelScorer(spark, root)(transactions)
    assert model.save_version(fitted, root) == 0
    requests = transactions.limit(300).drop("is_fraud", "idx")

    def run(part):
        requests.select(F.to_json(F.struct(*requests.columns)).alias("value")).write.text(f"{root}/in/{part}")
        messages = spark.readStream.schema("value string").option("recursiveFileLookup", True).text(f"{root}/in")
        scoring.score_stream(messages, model.ModelScorer(spark, root), f"{root}/out", f"{root}/checkpoint").awaitTermination()

    run(0)
    assert model.save_version(fitted, root) == 1 and model.latest_version(spark, root) == 1
    run(1)
    scores, moved = (spark.read.parquet(f"{root}/out/{t}") for t in ("scores", "transactions"))
    assert {(r[0], r[1]) for r in scores.groupBy("model_version").count().collect()} == {(0, 300), (1, 300)}
    names = [c for c in requests.columns]
    both = scores.join(moved, "idx")
    assert both.count() == 600 and both.where("(prediction = 'Yes') <> (is_fraud = 'Yes')").count() == 0
    batch = model.score(requests, fitted).select(F.to_json(F.struct(*names)).alias("k"), F.round("prob1", 9).alias("p")).distinct()
    stream = both.select(F.to_json(F.struct(*names)).alias("k"), F.round("prob1", 9).alias("p")).distinct()
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stream.collect()))
