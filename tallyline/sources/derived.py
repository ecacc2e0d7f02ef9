"""Wagering records derived from the ``events`` table, in SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DERIVED_SQL = """
WITH e AS (
  SELECT event_id, user_id, ts, event_type,
         CAST(value AS DECIMAL(12,2)) AS amt,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
         count(*) OVER (PARTITION BY user_id) AS cnt
  FROM events),
p AS (
  SELECT *,
    CASE WHEN event_id % 89 = 0 THEN CAST(1.00 AS DECIMAL(8,2))
         ELSE CAST(1.01 + (event_id % 500) * 0.01 AS DECIMAL(8,2)) END AS pr,
    CASE WHEN event_id % 97 = 0 THEN -amt ELSE amt END AS a,
    CASE WHEN event_id % 4 = 0 THEN 'bonus' ELSE 'cash' END AS st,
    CASE WHEN event_id % 3 = 0 THEN 'return' ELSE 'no-return' END AS br
  FROM e),
f AS (
  SELECT *,
    CAST(CASE WHEN br = 'no-return' THEN 0 WHEN st = 'cash' THEN a * pr ELSE a * (pr - 1) END AS DECIMAL(20,4)) AS po
  FROM p)
SELECT
  CAST(CASE WHEN event_id % 1009 = 0 THEN concat('x', CAST(event_id AS STRING))
            WHEN event_id % 211 = 0 AND event_id > 0 THEN CAST(event_id - 1 AS STRING)
            ELSE CAST(event_id AS STRING) END AS STRING) AS bet_id,
  CASE WHEN user_id % 61 = 1 THEN concat('customer-', CAST(user_id AS STRING))
       ELSE concat('00000000-0000-4000-8000-', lpad(CAST(user_id AS STRING), 12, '0')) END AS customer_id,
  CASE WHEN event_id % 401 = 0 THEN 'not-a-date' ELSE substr(CAST(ts AS STRING), 1, 19) END AS bet_datetime,
  CAST(CASE WHEN user_id % 37 = 0 AND rn >= 5 THEN rn + 1
            WHEN user_id % 7 = 0 AND rn = cnt AND cnt > 1 THEN rn - 1
            WHEN user_id % 41 = 0 AND rn = cnt THEN 0
            ELSE rn END AS STRING) AS bet_num,
  CASE WHEN event_id % 509 = 0 THEN 'abc' WHEN event_id % 419 = 0 THEN '' ELSE CAST(a AS STRING) END AS betting_amount,
  CASE WHEN event_id % 701 = 0 THEN 'n/a' ELSE CAST(pr AS STRING) END AS price,
  CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 'casino'
       WHEN event_type IN ('purchase', 'view') THEN 'racing' ELSE 'sports' END AS category,
  CASE WHEN event_id % 331 = 0 THEN 'free' ELSE st END AS stake_type,
  CASE WHEN event_id % 337 = 0 THEN 'void' ELSE br END AS bet_result,
  CAST(CASE WHEN event_id % 101 = 0 THEN po + 1 ELSE po END AS STRING) AS payout,
  CAST(CAST(CASE WHEN br = 'no-return' AND st = 'cash' THEN a WHEN br = 'no-return' THEN 0
            WHEN st = 'cash' THEN a - po ELSE -po END
       + CASE WHEN event_id % 103 = 0 THEN 1 ELSE 0 END AS DECIMAL(20,4)) AS STRING) AS return_for_entain,
  event_id + 2 AS source_row_number
FROM f
"""


def derived_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw frame: eleven text columns and ``source_row_number``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(DERIVED_SQL.replace("FROM events)", "FROM {events})"), events=events)
