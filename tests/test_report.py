import pytest
from pyspark.sql import functions as F

from cardlake.operators.report import coerce_olap, fraud_report, present
from tests.conftest import rows

TXN = [("u2", "Yes"), ("u1", "Yes"), ("u1", "Yes"), (None, "Yes"), ("u1", "No"), ("u3", "No"), ("u1", "yes")]
CARDS = [(0, "u1", 4344676511950444, None), (1, "u1", 5, "$9"), (2, "u1", 6, "$8"), (3, None, 7, "$1")]
USERS = [(0, "u1", "Ann", 33, "nan")]


def tables(frame, txn=TXN, cards=CARDS, users=USERS):
    return (frame([(i, *t) for i, t in enumerate(txn)], "idx int, user string, is_fraud string"),
            frame(cards, "idx int, user string, card_number long, credit_limit string"),
            frame(users, "idx int, user string, person string, current_age int, total_debt string"))


@pytest.mark.parametrize("mode, u1", [("reference", 6), ("transactions", 2)])
@pytest.mark.parametrize("flip", [False, True])
def test_golden(frame, mode, u1, flip):
    parts = tables(frame, *(x[::-1] if flip else x for x in (TXN, CARDS, USERS)))
    assert rows(coerce_olap(fraud_report(*parts, count_mode=mode))) == [
        ("u1", u1, "Ann", 33, None, "4344676511950444", "$9"), ("u2", 1, None, None, None, None, None)]


def test_person_text(frame):
    report = coerce_olap(fraud_report(*tables(frame)), compat_person=True)
    assert {r["user"]: r["person"] for r in report.collect()} == {"u1": "Ann", "u2": "None"}


def test_nothing(spark):
    empty = (spark.createDataFrame([], s) for s in (
        "idx int, user string, is_fraud string", "idx int, user string, card_number long, credit_limit string",
        "idx int, user string, person string, current_age int, total_debt string"))
    report = coerce_olap(fraud_report(*empty))
    assert report.collect() == []
    assert report.dtypes == [("user", "string"), ("count_fraud", "bigint"), ("person", "string"), ("current_age", "int"),
                             ("total_debt", "string"), ("card_number", "string"), ("credit_limit", "string")]


def test_fan_out_equals_the_join(frame):
    """Counted by hand, with several profile rows and a user that holds a third of everything."""
    txn = [(f"u{0 if i % 3 == 0 else i % 17}", "Yes" if i % 2 else "No") for i in range(600)]
    cards = [(i, f"u{0 if i % 3 == 0 else i % 19}", 100 + i, None if i % 4 else f"${i}") for i in range(90)]
    users = [(i, f"u{i % 13}", None if i < 3 else f"p{i}", 20 + i, f"${i}") for i in range(20)]
    got = {r["user"]: tuple(r) for r in fraud_report(*tables(frame, txn, cards, users)).collect()}

    def known(rows_of, user, place):
        return next((r[place] for r in rows_of if r[1] == user and r[place] is not None), None)

    want = {}
    for user in {name for name, flag in txn if flag == "Yes"}:
        frauds = sum(1 for name, flag in txn if name == user and flag == "Yes")
        n_cards = sum(1 for r in cards if r[1] == user) or 1
        n_profiles = sum(1 for r in users if r[1] == user) or 1
        want[user] = (user, frauds * n_cards * n_profiles, *[known(users, user, i) for i in (2, 3, 4)], *[known(cards, user, i) for i in (2, 3)])
    assert got == want


def test_order_for_presentation(frame):
    shown = present(coerce_olap(fraud_report(*tables(frame))))
    assert [(r["position"], r["user"]) for r in shown.orderBy("position").collect()] == [(0, "u1"), (1, "u2")]


def test_scored_rows_can_be_left_out(frame):
    txn, cards, users = tables(frame, [("u1", "Yes"), ("u1", "Yes")])
    marked = txn.withColumn("scored", F.col("idx") == 1)
    by_id = txn.withColumn("idx", F.col("idx") * 30_000_000)
    for df in (marked, by_id):
        assert fraud_report(df, cards, users, "transactions", exclude_scored=True).first()["count_fraud"] == 1
        assert fraud_report(df, cards, users, "transactions").first()["count_fraud"] == 2
