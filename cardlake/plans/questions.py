"""SQL over the tables, and the questions users ask of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COUNT_FRAUD_BY_USER = """
    SELECT user, count(*) AS count_fraud FROM transaction_topic
    WHERE is_fraud = 'Yes' AND user IS NOT NULL GROUP BY user
"""
# The newest rows are found before anything is joined to them.
SUSPICIOUS_TRANSACTIONS = """
    WITH newest AS (
        SELECT idx, user, card, year, month, day, time, amount, merchant_name FROM transaction_topic
        WHERE is_fraud = 'Yes' ORDER BY year DESC, month DESC, day DESC, lpad(time, 5, '0') DESC, idx DESC LIMIT :n),
    held AS (
        SELECT user, count(*) AS n_cards, min_by(card_number, idx) AS card_number FROM card_topic GROUP BY user)
    SELECT newest.*, u.person, u.total_debt, coalesce(held.n_cards, 0) AS n_cards, held.card_number
    FROM newest LEFT JOIN user_topic u ON u.user = newest.user LEFT JOIN held ON held.user = newest.user
"""


def register_views(**tables: DataFrame) -> None:
    """``register_views(user_topic=df, …)`` makes the tables known to SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def ask(spark: SparkSession, sql: str, **args) -> DataFrame:
    """Any SQL over the registered tables, with named parameters."""
    return spark.sql(sql, args=args or None)


def count_fraud_by_user(spark: SparkSession) -> DataFrame:
    return ask(spark, COUNT_FRAUD_BY_USER)


def suspicious_transactions(spark: SparkSession, n: int = 100) -> DataFrame:
    return ask(spark, SUSPICIOUS_TRANSACTIONS, n=n)
