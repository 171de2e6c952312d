"""Fraud report, cleaning, schemas, tables and SQL questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake import schemas
from cardlake.functions import cleaning as fn
from cardlake.operators import cleaning, ordering, report
from cardlake.plans import daily_report, questions
from cardlake.plans.registry import CARD, TXN, USER, query
from cardlake.session import scratch_path
from cardlake.sources import adapters, readers, sinks
from cardlake.streaming import ingest, topics

_REPORT_COLUMNS = """
  arg_min(u.person, u.idx) FILTER (WHERE u.person IS NOT NULL) AS person,
  arg_min(u.current_age, u.idx) FILTER (WHERE u.current_age IS NOT NULL) AS current_age,
  arg_min(u.total_debt, u.idx) FILTER (WHERE u.total_debt IS NOT NULL) AS total_debt,
  CAST(arg_min(c.card_number, c.idx) FILTER (WHERE c.card_number IS NOT NULL) AS VARCHAR) AS card_number,
  arg_min(c.credit_limit, c.idx) FILTER (WHERE c.credit_limit IS NOT NULL) AS credit_limit"""
_FANNED = f"""
  FROM txn t LEFT JOIN card c ON c."user" = t."user" LEFT JOIN usr u ON u."user" = t."user"
  WHERE t.is_fraud = 'Yes' AND t."user" IS NOT NULL GROUP BY t."user" """


def _report(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    sides = (adapters.transactions(spark, sf_dir), adapters.cards(spark, sf_dir), adapters.users(spark, sf_dir))
    return report.coerce_olap(report.fraud_report(*sides, count_mode=mode))


@query(f"""WITH {TXN}, {CARD}, {USER}
SELECT t."user", CAST(count(*) AS BIGINT) AS count_fraud, {_REPORT_COLUMNS} {_FANNED}""")
def fraud_report_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "reference")


@query(f"""WITH {TXN}, {CARD}, {USER}
SELECT t."user", CAST(count(DISTINCT t.idx) AS BIGINT) AS count_fraud, {_REPORT_COLUMNS} {_FANNED}""")
def fraud_report_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "transactions")


@query(f"""WITH {TXN}, {CARD}, {USER}, report AS (
  SELECT t."user", CAST(count(*) AS BIGINT) AS count_fraud, {_REPORT_COLUMNS} {_FANNED})
SELECT row_number() OVER (ORDER BY "user") - 1 AS position, * FROM report""")
def report_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.present(_report(spark, sf_dir, "reference"))


@query(f"""WITH {TXN}, {CARD}, {USER}
SELECT t."user", CAST(count(*) AS BIGINT) AS count_fraud, {_REPORT_COLUMNS} {_FANNED}""")
def daily_report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily job: topics → bronze → report → table, read back."""
    root = scratch_path(spark, "daily")

    def filled(df: DataFrame, schema) -> DataFrame:
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in schema.fields])

    for name, df in (("transaction-topic", adapters.transactions(spark, sf_dir)),
                     ("card-topic", adapters.cards(spark, sf_dir)), ("user-topic", adapters.users(spark, sf_dir))):
        topic = topics.TOPICS[name]
        topics.publish(filled(df, topic.schema), topic, f"{root}/source")
    running = [ingest.sink_bronze(topics.read_topic_stream(spark, f"{root}/source", t), t, f"{root}/bronze",
                                  f"{root}/checkpoint/{t.name}") for t in topics.TOPICS.values()]
    for q in running:
        q.awaitTermination()
    daily_report.run(spark, f"{root}/bronze", f"{root}/fraud_report", "20240701", stage_root=f"{root}/stage")
    return spark.read.parquet(f"{root}/fraud_report").drop("ds")


@query(f"""WITH {TXN}
SELECT idx, "user", "user" || '_' || card AS card_key, CAST(replace(replace(amount, '$', ''), ',', '') AS DOUBLE) AS amount,
  CASE WHEN is_fraud = 'Yes' THEN 1 ELSE 0 END AS label, coalesce(errors, 'No error') AS errors,
  strftime(strptime("year" || '-' || "month" || '-' || "day" || ' ' || "time", '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M:%S')
    AS event_time
FROM txn""")
def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = fn.event_time(*[F.col(c) for c in ("year", "month", "day", "time")])
    return adapters.transactions(spark, sf_dir).select(
        "idx", "user", fn.card_key(F.col("user"), F.col("card")).alias("card_key"),
        fn.money(F.col("amount")).alias("amount"), fn.yes_flag(F.col("is_fraud")).alias("label"),
        fn.or_default(F.col("errors")).alias("errors"), F.date_format(when, "yyyy-MM-dd HH:mm:ss").alias("event_time"))


@query("""SELECT event_id,
  CASE WHEN event_id % 6 < 4 THEN NULL WHEN event_id % 6 = 4 THEN 'none' ELSE event_type END AS note,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS amount FROM events""")
def clean_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    six = F.pmod("event_id", F.lit(6))
    return cleaning.canonical_nulls(adapters.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(six == 0, " NaN ").when(six == 1, "NA").when(six == 2, "").when(six == 3, " \t ").when(six == 4, "none")
        .otherwise(F.col("event_type")).alias("note"),
        F.when(F.pmod("event_id", F.lit(5)) == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("amount")))


@query("""SELECT event_id, CASE WHEN event_id % 4 < 2 THEN NULL WHEN event_id % 4 = 2 THEN 'NAN' ELSE event_type END AS mark
FROM events""")
def clean_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    four = F.pmod("event_id", F.lit(4))
    mark = F.when(four == 0, "None").when(four == 1, "NaN").when(four == 2, "NAN").otherwise(F.col("event_type"))
    return adapters.table(spark, sf_dir, "events").select("event_id", fn.null_if_sentinel(mark).alias("mark"))


@query(f"""WITH {TXN}
SELECT idx, is_fraud, errors, merchant_name, amount AS per_capita_income__zipcode FROM txn""")
def clean_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.transactions(spark, sf_dir).select(
        "idx", F.col("is_fraud").alias("Is Fraud?"), F.col("errors").alias(" Errors? "),
        F.col("merchant_name").alias("Merchant Name"), F.col("amount").alias("Per Capita Income - Zipcode"))
    cleaned = cleaning.snake_case_columns(raw)
    return cleaning.select_present(cleaned, ["idx", "is_fraud", "errors", "absent", "merchant_name",
                                             "per_capita_income__zipcode"])


@query("""SELECT p_partkey, lower(replace(regexp_replace(p_brand || ' - ' || p_type || '? ', '[^\\w\\s]', '', 'g')
  .rtrim(), ' ', '_')) AS name FROM part""")
def clean_text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("p_brand"), F.lit(" - "), F.col("p_type"), F.lit("? "))
    return adapters.table(spark, sf_dir, "part").select("p_partkey", fn.snake_case_value(text).alias("name"))


@query("""SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx, o_orderkey,
  'user' || (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) AS "user" FROM orders""")
def dense_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapters.table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    numbered = ordering.dense_index(orders, ["o_orderdate", "o_orderkey"], rows_per_range=1 << 12)
    return cleaning.prefix_ids(numbered, user="idx").drop("o_orderdate")


_FAULTY = f"""WITH {TXN}, faulty AS (
  SELECT * REPLACE (CASE WHEN idx % 41 = 0 THEN NULL ELSE "user" END AS "user",
    CASE WHEN idx % 31 = 0 THEN 'x' || "year" ELSE CAST("year" AS VARCHAR) END AS "year",
    CASE WHEN idx % 50 = 0 THEN NULL ELSE mcc END AS mcc) FROM txn)"""


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    def every(n: int):
        return F.pmod("idx", F.lit(n)) == 0
    return adapters.transactions(spark, sf_dir).withColumns({
        "user": F.when(~every(41), F.col("user")),
        "year": F.concat(F.when(every(31), "x").otherwise(""), F.col("year").cast("string")),
        "mcc": F.when(~every(50), F.col("mcc"))})


@query(f"""{_FAULTY}
SELECT * REPLACE (CAST("year" AS INT) AS "year") FROM faulty WHERE idx % 41 <> 0 AND idx % 31 <> 0 AND idx % 50 <> 0""")
def schema_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.enforce(_faulty(spark, sf_dir), schemas.TRANSACTION).valid


@query(f"""{_FAULTY}
SELECT CAST(idx AS VARCHAR) AS idx, "user", "year", CAST(mcc AS VARCHAR) AS mcc, concat_ws('; ',
  CASE WHEN "user" IS NULL THEN 'user: null' END, CASE WHEN idx % 31 = 0 THEN 'year: not int' END,
  CASE WHEN mcc IS NULL THEN 'mcc: null' END) AS reasons
FROM faulty WHERE idx % 41 = 0 OR idx % 31 = 0 OR idx % 50 = 0""")
def schema_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = schemas.enforce(_faulty(spark, sf_dir), schemas.TRANSACTION).rejects
    return rejects.select("idx", "user", "year", "mcc", F.array_join("reasons", "; ").alias("reasons"))


@query(f"""WITH {TXN}
SELECT * FROM (SELECT idx, "user", errors, is_fraud FROM txn WHERE is_fraud = 'No'
  UNION ALL BY NAME SELECT idx, "user", zip, is_fraud FROM txn WHERE is_fraud = 'Yes')""")
def union_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = adapters.transactions(spark, sf_dir)
    old = txn.where(F.col("is_fraud") == report.NOT_FRAUD).select("idx", "user", "errors", "is_fraud")
    new = report.fraud_only(txn).select("idx", "user", "zip", "is_fraud")
    return readers.union_all([old, new])


@query(f"""WITH {TXN} SELECT "user", CAST(count(*) AS BIGINT) AS count_fraud FROM txn WHERE is_fraud = 'Yes' GROUP BY 1""")
def count_fraud_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions.register_views(transaction_topic=adapters.transactions(spark, sf_dir))
    return questions.count_fraud_by_user(spark)


@query(f"""WITH {TXN}, {CARD}, {USER}
SELECT t.idx, t."user", t.card, t."year", t."month", t."day", t."time", t.amount, t.merchant_name, u.person, u.total_debt,
  (SELECT count(*) FROM card c WHERE c."user" = t."user") AS n_cards,
  (SELECT arg_min(card_number, idx) FROM card c WHERE c."user" = t."user") AS card_number
FROM (SELECT * FROM txn WHERE is_fraud = 'Yes'
      ORDER BY "year" DESC, "month" DESC, "day" DESC, lpad("time", 5, '0') DESC, idx DESC LIMIT 100) t
LEFT JOIN usr u ON u."user" = t."user" """)
def suspicious_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions.register_views(transaction_topic=adapters.transactions(spark, sf_dir),
                             card_topic=adapters.cards(spark, sf_dir), user_topic=adapters.users(spark, sf_dir))
    return questions.suspicious_transactions(spark, 100)


@query(f"""WITH {TXN} SELECT idx AS position, * FROM txn""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions written as CSV in order, read back, and numbered by their place in the files."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(adapters.transactions(spark, sf_dir).orderBy("idx"), path)
    return readers.read_csv(spark, path, schemas.TRANSACTION, index="position")


@query("""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id, CASE doc_id % 5 WHEN 0 THEN chr(10) || 'a "b",' || chr(13) || chr(10)
  || text WHEN 1 THEN '"' || lang || chr(10) WHEN 2 THEN NULL ELSE text END AS text, CASE WHEN doc_id % 3 > 0 THEN source END AS source FROM documents""")
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, quotes and commas written as CSV in order, read back by splits, and numbered."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(adapters.texts_for_csv(spark, sf_dir).orderBy("doc_id"), path)
    return readers.read_csv(spark, path, adapters.texts_for_csv(spark, sf_dir).schema, index="position")


@query(f"""WITH {CARD} SELECT idx, "user", card_number, credit_limit FROM card""")
def stage_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stage")
    cards = adapters.cards(spark, sf_dir)
    sinks.write_stage(cards, root, "card", "20240701")
    sinks.write_stage(cards, root, "card", "20240702")
    sinks.write_stage(cards, root, "card", "20240701")  # a second run of a date replaces the first
    return readers.read_stage(spark, root, "card", "20240701")


@query(f"""WITH {TXN} SELECT idx, "user", amount, is_fraud, '20240701' AS ds FROM txn
UNION ALL SELECT idx, "user", amount, is_fraud, '20240702' AS ds FROM txn""")
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "table")
    rows = adapters.transactions(spark, sf_dir).select("idx", "user", "amount", "is_fraud")
    for ds in ("20240701", "20240702", "20240701"):
        sinks.append_table(rows, path, ["idx"], ds)
    return spark.read.parquet(path).withColumn("ds", F.col("ds").cast("string"))


@query("""SELECT 'transaction' AS table_name, count(*) AS n FROM events UNION ALL SELECT 'card', count(*) FROM orders
UNION ALL SELECT 'user', count(*) FROM customer""")
def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.record_counts({"transaction": adapters.transactions(spark, sf_dir),
                                  "card": adapters.cards(spark, sf_dir), "user": adapters.users(spark, sf_dir)})
