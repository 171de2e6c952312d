import math

import pytest
from pyspark.sql import functions as F

from cardlake.functions import cleaning as fn
from cardlake.operators import cleaning
from tests.conftest import rows


@pytest.mark.parametrize("raw, clean", [
    ("Is Fraud?", "is_fraud"), ("Errors?", "errors"), ("CARD INDEX", "card_index"), (" Zip ", "zip"),
    ("Per Capita Income - Zipcode", "per_capita_income__zipcode"), ("Yearly Income - Person", "yearly_income__person"),
    ("Card on Dark Web", "card_on_dark_web"), ("Stadt (Größe)", "stadt_größe")])
def test_names(spark, frame, raw, clean):
    df = spark.createDataFrame([(raw,)], "c string")
    assert fn.snake_case(raw) == clean
    assert df.select(fn.snake_case_value(F.col("c"))).first()[0] == clean
    assert cleaning.snake_case_columns(df.withColumnRenamed("c", raw)).columns == [clean]


def test_null_words(frame):
    df = frame([(i, t, v) for i, (t, v) in enumerate([
        (" NaN ", 1.0), ("NA", math.nan), ("", None), ("  ", 2.0), ("none", 3.0), ("Nan City", 4.0), (None, 5.0)])],
        "i int, t string, v double")
    found = {r["i"]: (r["t"], r["v"]) for r in cleaning.canonical_nulls(df).collect()}
    assert found == {0: (None, 1.0), 1: (None, None), 2: (None, None), 3: (None, 2.0), 4: ("none", 3.0),
                     5: ("Nan City", 4.0), 6: (None, 5.0)}


def test_sentinels_are_exact(frame):
    df = frame([(t,) for t in ("nan", "None", "NaN", "NAN", "x", None)], "t string")
    kept = sorted(r[0] for r in df.select(fn.null_if_sentinel(F.col("t"))).collect() if r[0] is not None)
    assert kept == ["NAN", "x"]


def test_money(frame):
    df = frame([("$1,200.50",), ("$-99.00",), ("1200",), ("x",), (None,)], "t string")
    found = {r[0]: r[1] for r in df.select("t", fn.money(F.col("t"))).collect()}
    assert found == {"$1,200.50": 1200.5, "$-99.00": -99.0, "1200": 1200.0, "x": None, None: None}


def test_keys_and_times(spark):
    df = spark.createDataFrame([("u1", 2, 2018, 7, 4, "9:07"), (None, 2, 2019, 2, 30, "15:03")],
                               "user string, card int, y int, m int, d int, t string")
    out = df.select(fn.card_key(F.col("user"), F.col("card")).alias("k"),
                    fn.event_time(*[F.col(c) for c in "ymdt"]).cast("string").alias("at"),
                    fn.prefixed("card", F.col("card")).alias("card")).collect()
    assert [tuple(r) for r in out] == [("u1_2", "2018-07-04 09:07:00", "card2"), (None, None, "card2")]


def test_text_field(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), (None, "b"), (None, None)], "content string, message string")
    assert [r[0] for r in df.select(fn.text_field(F.col("content"), F.col("message"))).collect()] == ["a", "b", "b", None]


def test_select_present(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert cleaning.select_present(df, ["b", "z", "a"]).columns == ["b", "a"]
    assert rows(cleaning.prefix_ids(df, user="a")) == [(1, 2, "user1")]
