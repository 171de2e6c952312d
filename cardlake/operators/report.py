"""The per-user fraud report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardlake.functions.cleaning import null_if_sentinel
from cardlake.operators.ordering import dense_index

# Labels, and the range of ids that scored transactions get.
FRAUD = "Yes"
NOT_FRAUD = "No"
FIRST_SCORED_IDX = 26_000_001
LAST_SCORED_IDX = 10 ** 9


def fraud_only(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("is_fraud") == FRAUD)


def _first(column: str, order: str) -> Column:
    """The first value that is not null, in the order of ``order``."""
    return F.expr(f"min_by(`{column}`, `{order}`) FILTER (WHERE `{column}` IS NOT NULL)").alias(column)


def per_user(df: DataFrame, columns: Sequence[str], order: str, count: str) -> DataFrame:
    """Row count and first values of each user."""
    return (df.where(F.col("user").isNotNull()).groupBy("user")
            .agg(F.count("*").alias(count), *[_first(c, order) for c in columns]))


def fraud_report(transactions: DataFrame, cards: DataFrame, users: DataFrame, count_mode: str = "reference",
                 order: str = "idx", exclude_scored: bool = False) -> DataFrame:
    """Frauds per user, with the first known card and profile values.

    ``count_mode="reference"`` counts the rows of transactions ⟕ cards ⟕ users, so a fraud counts once per card and
    profile row of its user; ``"transactions"`` counts the frauds. The joined rows are never built: each side is reduced
    to a row per user first, and the counts are multiplied.

    ``exclude_scored`` leaves out transactions that the scoring job added: those marked ``scored``, or else those whose id
    is in its range.
    """
    if count_mode not in ("reference", "transactions"):
        raise ValueError(f"unknown count_mode {count_mode!r}")
    if exclude_scored:
        added = F.col("scored") if "scored" in transactions.columns else F.col("idx") >= FIRST_SCORED_IDX
        transactions = transactions.where(~F.coalesce(added, F.lit(False)))
    frauds = (fraud_only(transactions).where(F.col("user").isNotNull())
              .groupBy("user").agg(F.count("*").alias("n_frauds")))
    per_card = per_user(cards, ["card_number", "credit_limit"], order, "n_cards")
    profile = per_user(users, ["person", "current_age", "total_debt"], order, "n_profiles")
    joined = frauds.join(per_card, "user", "left").join(profile, "user", "left")
    counted = F.col("n_frauds")
    if count_mode == "reference":
        for n in ("n_cards", "n_profiles"):
            counted = counted * F.coalesce(F.col(n), F.lit(1))
    return joined.select("user", counted.alias("count_fraud"), "person", "current_age", "total_debt", "card_number",
                         "credit_limit")


def present(report: DataFrame) -> DataFrame:
    """The report in the order of its users, with ``position`` from 0. Only what is shown needs the order; tables are sorted by count."""
    return dense_index(report, ["user"], "position")


def coerce_olap(report: DataFrame, compat_person: bool = False) -> DataFrame:
    """The report in the column types of its table; texts that stand for null become null.

    ``compat_person=True`` writes the text ``None`` for a missing person, as a plain text conversion would.
    """
    person = F.col("person").cast("string")
    texts = {c: null_if_sentinel(F.col(c).cast("string")).alias(c) for c in ("total_debt", "card_number", "credit_limit")}
    return report.select(
        F.col("user").cast("string").alias("user"), F.col("count_fraud").cast("long").alias("count_fraud"),
        (F.coalesce(person, F.lit("None")) if compat_person else person).alias("person"),
        F.col("current_age").cast("int").alias("current_age"), *texts.values())
