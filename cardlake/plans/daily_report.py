"""The daily job: bronze topics → fraud report → table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake import schemas
from cardlake.operators.report import FRAUD, coerce_olap, fraud_report
from cardlake.session import stage, staged_until_done
from cardlake.sources.readers import read_stage, read_topic
from cardlake.sources.sinks import append_table, write_stage


def build_report(spark: SparkSession, bronze: str, count_mode: str = "reference", fmt: str = "parquet",
                 exclude_scored: bool = False) -> DataFrame:
    """The report as one lazy plan over the bronze files; filter and columns reach the scans."""
    columns = ["user", "is_fraud", *["idx"] * exclude_scored]
    transactions = read_topic(spark, bronze, "transaction-topic", schemas.TRANSACTION, columns, F.col("is_fraud") == FRAUD, fmt)
    users = read_topic(spark, bronze, "user-topic", schemas.USER, ["idx", "user", "person", "current_age", "total_debt"],
                       fmt=fmt)
    cards = read_topic(spark, bronze, "card-topic", schemas.CARD, ["idx", "user", "card_number", "credit_limit"], fmt=fmt)
    return coerce_olap(fraud_report(transactions, cards, users, count_mode, exclude_scored=exclude_scored))


def run(spark: SparkSession, bronze: str, table: str, ds: str, count_mode: str = "reference",
        stage_root: str | None = None, mode: str = "replace_ds", fmt: str = "parquet", exclude_scored: bool = False) -> None:
    """Write the report of run date ``ds``; with ``stage_root`` also keep it among the staged tables. ``exclude_scored`` leaves out
    what the scoring stream sent back to the topic.

    The range layout of the table looks at its input twice, so the report is written once before it.
    """
    with staged_until_done(spark):
        report = build_report(spark, bronze, count_mode, fmt, exclude_scored)
        if stage_root:
            write_stage(report, stage_root, "fraud_report", ds)
            report = read_stage(spark, stage_root, "fraud_report", ds, report.schema)
        else:
            report = stage(report, "fraud-report")
        append_table(report, table, ["count_fraud", "user"], ds, mode)
