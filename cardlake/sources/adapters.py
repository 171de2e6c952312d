"""The test tables seen as the card domain. Renames and derivations only; no operator knows these tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions_of(events: DataFrame) -> DataFrame:
    """Transactions from event rows, batch or stream."""
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").cast("int").alias("idx"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user"),
        F.concat(F.lit("card"), F.pmod("event_id", F.lit(4)).cast("string")).alias("card"),
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"),
        F.concat(F.hour("ts").cast("string"), F.lit(":"), F.lpad(F.minute("ts").cast("string"), 2, "0")).alias("time"),
        F.concat(F.lit("$"), F.col("value").cast("string")).alias("amount"),
        F.when(kind == "view", "Swipe Transaction").when(kind == "click", "Chip Transaction")
        .otherwise("Online Transaction").alias("use_chip"),
        F.pmod("event_id", F.lit(97)).alias("merchant_name"),
        F.concat(F.lit("city"), F.pmod("user_id", F.lit(23)).cast("string")).alias("merchant_city"),
        F.when(kind != "purchase", F.concat(F.lit("S"), F.pmod("user_id", F.lit(7)).cast("string")))
        .alias("merchant_state"),
        F.when(kind != "purchase", (F.lit(10000) + F.pmod("user_id", F.lit(23))).cast("double")).alias("zip"),
        F.get_json_object("props", "$.k").try_cast("int").alias("mcc"),
        F.when(kind == "signup", "Bad PIN").alias("errors"),
        F.when(kind == "error", "Yes").otherwise("No").alias("is_fraud"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(table(spark, sf_dir, "events"))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("idx"),
        F.concat(F.lit("user"), F.col("o_custkey").cast("string")).alias("user"),
        (F.lit(4_000_000_000_000_000) + F.col("o_orderkey")).alias("card_number"),
        F.concat(F.lit("$"), F.round("o_totalprice").cast("long").cast("string")).alias("credit_limit"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("idx"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string")).alias("user"),
        F.col("c_name").alias("person"),
        (F.lit(18) + F.pmod("c_custkey", F.lit(60))).cast("int").alias("current_age"),
        F.concat(F.lit("$"), F.col("c_acctbal").cast("string")).alias("total_debt"))


def labelled_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as card payments: the customer's card pays the supplier, a returned item counts as fraud."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(orders, "l_orderkey").select(
        F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("_card")).alias("card_id"),
        F.col("l_suppkey").alias("merchant"), F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber"),
        F.col("l_quantity"), F.col("l_extendedprice").alias("amount"), F.col("l_discount"), F.col("l_tax"),
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
        F.dayofmonth("l_shipdate").alias("day"), F.col("l_linestatus"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))


def texts_for_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts; some begin with a line break, hold quotes and commas, end with a line break or are empty."""
    kind = F.pmod("doc_id", F.lit(5))
    text = (F.when(kind == 0, F.concat(F.lit('\na "b",\r\n'), "text")).when(kind == 1, F.concat(F.lit('"'), "lang", F.lit("\n")))
            .when(kind == 2, "").otherwise(F.col("text")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.alias("text"), F.when(F.pmod("doc_id", F.lit(3)) > 0, F.col("source")).alias("source"))
