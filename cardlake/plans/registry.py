"""The registered queries, each next to the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Adapter views in SQL; the Spark side is cardlake.sources.adapters.
TXN = """
txn AS (
  SELECT CAST(event_id AS INT) AS idx, 'user' || user_id AS "user", 'card' || (event_id % 4) AS card,
    CAST(year(ts) AS INT) AS "year", CAST(month(ts) AS INT) AS "month", CAST(day(ts) AS INT) AS "day",
    hour(ts) || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') AS "time", '$' || CAST(value AS VARCHAR) AS amount,
    CASE event_type WHEN 'view' THEN 'Swipe Transaction' WHEN 'click' THEN 'Chip Transaction'
      ELSE 'Online Transaction' END AS use_chip,
    event_id % 97 AS merchant_name, 'city' || (user_id % 23) AS merchant_city,
    CASE WHEN event_type <> 'purchase' THEN 'S' || (user_id % 7) END AS merchant_state,
    CASE WHEN event_type <> 'purchase' THEN CAST(10000 + user_id % 23 AS DOUBLE) END AS zip,
    CAST(props->>'$.k' AS INT) AS mcc, CASE WHEN event_type = 'signup' THEN 'Bad PIN' END AS errors,
    CASE WHEN event_type = 'error' THEN 'Yes' ELSE 'No' END AS is_fraud
  FROM events)"""
CARD = """
card AS (
  SELECT o_orderkey AS idx, 'user' || o_custkey AS "user", 4000000000000000 + o_orderkey AS card_number,
    '$' || CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) AS credit_limit
  FROM orders)"""
USER = """
usr AS (
  SELECT c_custkey AS idx, 'user' || c_custkey AS "user", c_name AS person, CAST(18 + c_custkey % 60 AS INT) AS current_age,
    '$' || CAST(c_acctbal AS VARCHAR) AS total_debt
  FROM customer)"""
EDGE = """
edge AS (
  SELECT 'user' || o_custkey || '_card' AS card_id, l_suppkey AS merchant, l_orderkey, l_partkey, l_linenumber, l_quantity,
    l_extendedprice AS amount, l_discount, l_tax, CAST(year(l_shipdate) AS INT) AS "year",
    CAST(month(l_shipdate) AS INT) AS "month", CAST(day(l_shipdate) AS INT) AS "day", l_linestatus,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query and its SQL. Queries without SQL are checked against brute force in the tests."""
    def add(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run
    return add
