import pytest
from pyspark.sql import functions as F

from cardlake.operators import features, sampling
from tests.conftest import rows


def test_codes_follow_the_type(frame):
    df = frame([(1, 100, "b"), (2, 9, "a"), (3, 20, None), (4, 9, "é")], "idx int, mcc int, city string")
    codes = features.fit_label_codes(df, ["mcc", "city"])
    assert rows(features.apply_label_codes(df, codes)) == [(1, 2, 1), (2, 0, 0), (3, 1, None), (4, 0, 2)]


@pytest.mark.parametrize("policy", ["error", "zero", "reject"])
def test_unseen_values(frame, policy):
    codes = features.fit_label_codes(frame([("a",), ("b",)], "city string"), ["city"])
    df = frame([(1, "b"), (2, "new"), (3, ""), (4, None)], "idx int, city string")
    out = features.apply_label_codes(df, codes, unseen=policy, falsy_zero=True)
    if policy == "error":
        with pytest.raises(Exception, match="no code for city: new"):
            out.collect()
        return
    found = {r["idx"]: (r["city"], tuple(r["unseen"]) if policy == "reject" else ()) for r in out.collect()}
    assert found == {1: (1, ()), 2: (0, ()) if policy == "zero" else (None, ("city",)), 3: (0, ()), 4: (0, ())}


def test_minmax(frame):
    df = frame([(1.0, 7.0), (3.0, 7.0), (2.0, 7.0)], "a double, b double")
    fitted = features.fit_minmax(df, ["a", "b"])
    assert rows(features.apply_minmax(df, fitted)) == [(0.0, 0.0), (0.5, 0.0), (1.0, 0.0)]
    later = frame([(5.0, 9.0)], "a double, b double")
    assert rows(features.apply_minmax(later, fitted)) == [(2.0, 2.0)]


def test_prepare(frame):
    df = frame([(1, "user9", "card1", 2016, 8, 30, "$1,740.00", None, 4711000123456789012, "Springfield", 5411, None, "Yes")],
               "idx int, user string, card string, year int, month int, day int, amount string, use_chip string, "
               "merchant_name long, merchant_city string, mcc int, errors string, is_fraud string")
    row = features.prepare(df).first()
    assert (row["card_id"], row["amount"], row["errors"], row["label"]) == ("user9_card1", 1740.0, "No error", 1)
    ready = features.prepare(df).withColumns({c: F.lit(1.0) for c in ("merchant_city", "use_chip", "errors")})
    assert ready.select(features.edge_attr().alias("v")).first()["v"] == [1740.0, 1.0, 1.0, 2016.0, 8.0, 30.0, 1.0]


@pytest.mark.parametrize("small", [3, 100_000])
@pytest.mark.parametrize("n", [0, 1, 137, 900, 2000])
def test_exact_samples(frame, monkeypatch, small, n):
    """With a small limit the threshold is found by several rounds of prefix counts."""
    monkeypatch.setattr(sampling, "_SMALL", small)
    df = frame([(i,) for i in range(900)], "idx int")
    taken = {r[0] for r in sampling.take_exactly(df, n, "idx").collect()}
    assert len(taken) == min(n, 900)
    by_hash = [r[0] for r in df.orderBy(sampling.shuffle_key(F.col("idx"))).collect()]
    assert taken == set(by_hash[:n])


def test_rebalance(frame):
    df = frame([(i, "Yes" if i % 10 == 0 else "No") for i in range(500)], "idx int, is_fraud string")
    out = sampling.rebalance(df, 40)
    assert {r[0]: r[1] for r in out.groupBy("is_fraud").count().collect()} == {"Yes": 50, "No": 40}
    assert rows(out.repartition(5)) == rows(sampling.rebalance(df.repartition(1), 40))
    assert rows(out) != rows(sampling.rebalance(df, 40, seed=1))
    with pytest.raises(ValueError):
        sampling.rebalance(df, 451)
    assert sampling.rebalance(df, 451, strict=False).count() == 500


@pytest.mark.parametrize("small", [3, 100_000])
def test_stratified_split(frame, monkeypatch, small):
    monkeypatch.setattr(sampling, "_SMALL", small)
    df = frame([(i, 1 if i % 7 == 0 else 0) for i in range(1003)], "idx int, label int")
    out = sampling.stratified_split(df, "label")
    found = {(r[0], r[1]): r[2] for r in out.groupBy("label", "split").count().collect()}
    assert found[0, "test"] + found[1, "test"] == 201  # ceil(0.2 * 1003)
    assert (found[1, "train"], found[1, "test"]) == (115, 29)
    assert out.count() == 1003 and out.select("idx").distinct().count() == 1003
    near = sampling.stratified_split(df, "label", mode="threshold").where("split = 'test'").count()
    assert 150 < near < 250


def test_split_quotas():
    assert sampling.split_quotas({"a": 5, "b": 5}, 0.2) == {"a": 1, "b": 1}
    assert sampling.split_quotas({0: 3, 1: 3, 2: 3}, 0.5) == {0: 1, 1: 2, 2: 2}  # ties go to the smaller label's train part
    assert sampling.split_quotas({}, 0.2) == {}


def test_split_with_many_labels(frame):
    df = frame([(i, f"l{i % 90}" if i % 7 else None) for i in range(3000)], "idx long, label string")
    out = sampling.stratified_split(df, "label", test_size=0.2)
    assert out.count() == 3000 and out.where("split = 'test'").count() == 600
    got = {r["label"]: r["c"] for r in out.where("split = 'test'").groupBy("label").agg(F.count("*").alias("c")).collect()}
    sizes = {r["label"]: r["c"] for r in df.groupBy("label").agg(F.count("*").alias("c")).collect()}
    assert all(abs(got.get(s, 0) - 0.2 * n) <= 1 for s, n in sizes.items())


def test_rebalance_without_keys(frame):
    df = frame([(i if i % 3 else None, "Yes" if i % 10 == 0 else "No") for i in range(300)], "idx long, is_fraud string")
    out = sampling.rebalance(df, 20)
    assert out.where("is_fraud = 'No'").count() == 20 and out.where("is_fraud = 'Yes'").count() == 30


@pytest.mark.parametrize("labels", [1, 50, 65])
def test_split_has_one_rule_for_rows_without_a_key(frame, labels):
    """650 rows have no key: they count for the quota of their label and are train, whatever the number of labels."""
    df = frame([(i if i >= 650 else None, f"l{i % labels}") for i in range(3250)], "idx long, label string")
    out = sampling.stratified_split(df, "label", test_size=0.2)
    assert out.where("idx IS NULL AND split = 'train'").count() == 650
    assert out.where("split = 'test'").count() == 650
    by_label = {r[0]: r[1] for r in out.where("split = 'test'").groupBy("label").count().collect()}
    assert len(by_label) == labels and all(abs(n - 650 / labels) <= 1 for n in by_label.values())


def test_split_takes_the_first_by_hash(frame):
    import hashlib
    data = [(i, i % 3) for i in range(2000)]
    out = sampling.stratified_split(frame(data, "idx long, label int"), "label", test_size=0.1)
    quotas = sampling.split_quotas({s: sum(1 for _, x in data if x == s) for s in range(3)}, 0.1)
    want = set()
    for s, quota in quotas.items():
        own = sorted((i for i, x in data if x == s), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
        want |= set(own[:quota])
    assert {r["idx"] for r in out.where("split = 'test'").collect()} == want


def test_split_with_too_few_keys_or_rows(frame):
    df = frame([(None, "a")] * 8 + [(1, "a"), (2, "a")], "idx long, label string")
    assert sorted(r["split"] for r in sampling.stratified_split(df, "label", test_size=0.5).collect()) == ["test"] * 2 + ["train"] * 8
    assert sampling.stratified_split(df.limit(0), "label").collect() == []
