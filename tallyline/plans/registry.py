"""Queries of the engine's own operators and the SQL that checks them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from tallyline.operators import features, partition, rules
from tallyline.plans import runs
from tallyline.sources.derived import DERIVED_SQL, derived_bets
from tallyline.sources.store import Store

BUCKETS = 7
RULES = ["bet_id_integer", "customer_id_uuid", "bet_datetime_parseable", "bet_num_integer", "bet_num_positive", *(f"{c}_numeric" for c in rules.MONEY), "betting_amount_gt_0", "price_gt_1", "category_domain", "stake_type_domain", "bet_result_domain", "payout_rule_not_evaluable", "payout_formula", "return_for_entain_rule_not_evaluable", "return_for_entain_formula", "bet_id_unique", "customer_bet_num_unique", "customer_bet_num_sequence"]
MEANS = ["mean_betting_amount", "mean_price", "pct_racing", "pct_cash", "pct_return"]


def _annotated(spark, sf_dir, mode="batch"):
    return rules.annotate(derived_bets(spark, sf_dir), mode=mode)


def _library(spark, sf_dir):
    return _annotated(spark, sf_dir, "library").select("source_row_number", F.array_join("errors", "|").alias("validation_errors"))


def _buckets(spark, sf_dir):
    rows = derived_bets(spark, sf_dir).select("customer_id", partition.bucket(F.col("customer_id"), BUCKETS).alias("bucket"))
    per_customer = rows.groupBy("customer_id", "bucket").agg(F.count(F.lit(1)).alias("bets"))
    return per_customer.groupBy("bucket").agg(F.count(F.lit(1)).alias("customers"), F.sum("bets").alias("bets"))


def _flagged(rule):
    return lambda s, d: _annotated(s, d).where(F.array_contains("errors", rule)).select("source_row_number")


def _features(n):
    def query(spark, sf_dir):
        found = features.build_features(rules.valid(_annotated(spark, sf_dir)), n)
        return found.withColumns({c: F.round(c, 12) for c in MEANS})

    return query


def published(spark, sf_dir, partitions=4):
    """A published run over the derived records as CSV; its manifest.

    Files lie in the folder that the executors share; only a session without one (tests) gets a temporary one.
    """
    root = f"{spark.conf.get('spark.checkpoint.dir', None) or tempfile.mkdtemp(prefix='runs-')}/runs-{uuid.uuid4().hex}"
    Store(spark).write_csv(derived_bets(spark, sf_dir).orderBy("source_row_number"), f"{root}/bets.csv", rules.COLUMNS)
    return runs.build_features(spark, f"{root}/bets.csv", root, "r", runs.RunConfig(partition_count=partitions))


def _published(table, *without):
    return lambda s, d: s.read.parquet(published(s, d)["outputs"][f"{table}_dir"] + ("/customer_features" if table == "features" else "")).drop(*without)


def _published_features(spark, sf_dir):
    return _published("features", "feature_generated_at")(spark, sf_dir).withColumns({c: F.round(c, 12) for c in MEANS})


def _published_report(spark, sf_dir):
    counts = published(spark, sf_dir)["validation"]["failure_counts_by_rule"]
    return spark.createDataFrame(list(counts.items()), "rule string, failures long")


QUERIES = {
    "bronze_projection": lambda s, d: rules.project(derived_bets(s, d)),
    "annotated_errors": lambda s, d: _annotated(s, d).select("source_row_number", F.array_join("errors", "|").alias("validation_errors")),
    "valid_bets": lambda s, d: rules.valid(_annotated(s, d)),
    "invalid_bets": lambda s, d: rules.invalid(_annotated(s, d)),
    "failure_counts": lambda s, d: rules.failure_counts(_annotated(s, d)),
    "failures_ranked": lambda s, d: rules.failure_counts(_annotated(s, d)).orderBy(F.desc("failures"), "rule"),
    "validation_totals": lambda s, d: rules.totals(_annotated(s, d)),
    "first_occurrence": lambda s, d: rules.first_rows(rules.project(derived_bets(s, d))),
    "sequence_gaps": lambda s, d: rules.gaps(rules._parsed(rules.project(derived_bets(s, d)))),
    "customer_features_n20": _features(20),
    "customer_features_n10": _features(10),
    "incomplete_first_n": lambda s, d: features.completeness(_features(20)(s, d), 20),
    "library_mode_errors": _library,
    "hash_partition_counts": _buckets,
    "source_row_resolution": lambda s, d: rules.project(derived_bets(s, d)).agg(F.min("source_row_number").alias("first_row"), F.max("source_row_number").alias("last_row"), F.count_distinct("source_row_number").alias("total_rows")),
    "failure_combinations": lambda s, d: rules.invalid(_annotated(s, d)).groupBy("validation_errors").agg(F.count(F.lit(1)).alias("total_rows")),
    "csv_raw_bets": _published("raw_bets"),
    "csv_valid_bets": _published("valid_bets"),
    "csv_invalid_bets": _published("invalid_bets", "validated_at"),
    "csv_customer_features": _published_features,
    "csv_failure_counts": _published_report,
} | {f"rule_{rule}": _flagged(rule) for rule in RULES}

_NUM = r"'^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$'"
_PARSED = f"""
WITH raw AS ({DERIVED_SQL}),
b AS (SELECT *,
  CASE WHEN regexp_matches(bet_id, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(bet_id AS BIGINT) END AS p_id,
  CASE WHEN regexp_matches(bet_num, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(bet_num AS BIGINT) END AS p_num,
  TRY_CAST(bet_datetime AS TIMESTAMP) AS p_ts,
  CASE WHEN regexp_matches(betting_amount, {_NUM}) THEN TRY_CAST(betting_amount AS DECIMAL(18,8)) END AS a,
  CASE WHEN regexp_matches(price, {_NUM}) THEN TRY_CAST(price AS DECIMAL(18,8)) END AS q,
  CASE WHEN regexp_matches(payout, {_NUM}) THEN TRY_CAST(payout AS DECIMAL(18,8)) END AS o,
  CASE WHEN regexp_matches(return_for_entain, {_NUM}) THEN TRY_CAST(return_for_entain AS DECIMAL(18,8)) END AS r FROM raw),
firsts AS (SELECT bet_id AS fid, min(source_row_number) AS first_row, count(*) AS occurrences FROM b WHERE bet_id <> '' GROUP BY 1 HAVING count(*) > 1),
gaps AS (SELECT customer_id AS gid, count(DISTINCT p_num) AS distinct_nums, max(p_num) AS last_num FROM b WHERE customer_id <> '' AND p_num > 0 GROUP BY 1 HAVING count(DISTINCT p_num) <> max(p_num)),
w AS (SELECT b.*, firsts.first_row, gaps.gid, min(source_row_number) OVER (PARTITION BY customer_id, p_num) AS first_same,
  CASE WHEN bet_result = 'no-return' THEN 0 WHEN bet_result = 'return' AND stake_type = 'cash' THEN CAST(a AS DOUBLE) * CAST(q AS DOUBLE) WHEN bet_result = 'return' AND stake_type = 'bonus' THEN CAST(a AS DOUBLE) * (CAST(q AS DOUBLE) - 1) END AS xo,
  CASE WHEN bet_result = 'no-return' AND stake_type = 'cash' THEN CAST(a AS DOUBLE) WHEN bet_result = 'no-return' AND stake_type = 'bonus' THEN 0 WHEN bet_result = 'return' AND stake_type = 'cash' THEN CAST(a AS DOUBLE) - CAST(o AS DOUBLE) WHEN bet_result = 'return' AND stake_type = 'bonus' THEN -CAST(o AS DOUBLE) END AS xr
  FROM b LEFT JOIN firsts ON fid = bet_id LEFT JOIN gaps ON gid = customer_id),
x AS (SELECT *, list_sort(list_filter([
  {", ".join(f"CASE WHEN {c} = '' THEN 'missing_value:{c}' END" for c in rules.COLUMNS)},
  CASE WHEN p_id IS NULL THEN 'bet_id_integer' END,
  CASE WHEN NOT regexp_matches(replace(customer_id, '-', ''), '^[0-9a-fA-F]{{32}}$') THEN 'customer_id_uuid' END,
  CASE WHEN p_ts IS NULL THEN 'bet_datetime_parseable' END,
  CASE WHEN p_num IS NULL THEN 'bet_num_integer' END, CASE WHEN p_num < 1 THEN 'bet_num_positive' END,
  CASE WHEN a IS NULL THEN 'betting_amount_numeric' END, CASE WHEN a <= 0 THEN 'betting_amount_gt_0' END,
  CASE WHEN q IS NULL THEN 'price_numeric' END, CASE WHEN q <= 1 THEN 'price_gt_1' END,
  CASE WHEN o IS NULL THEN 'payout_numeric' END, CASE WHEN r IS NULL THEN 'return_for_entain_numeric' END,
  CASE WHEN category NOT IN ('sports', 'racing') THEN 'category_domain' END, CASE WHEN stake_type NOT IN ('cash', 'bonus') THEN 'stake_type_domain' END, CASE WHEN bet_result NOT IN ('return', 'no-return') THEN 'bet_result_domain' END,
  CASE WHEN a IS NOT NULL AND q IS NOT NULL AND o IS NOT NULL AND xo IS NULL THEN 'payout_rule_not_evaluable' END,
  CASE WHEN a IS NOT NULL AND q IS NOT NULL AND o IS NOT NULL AND abs(o - xo) > 0.00001 THEN 'payout_formula' END,
  CASE WHEN a IS NOT NULL AND o IS NOT NULL AND r IS NOT NULL AND xr IS NULL THEN 'return_for_entain_rule_not_evaluable' END,
  CASE WHEN a IS NOT NULL AND o IS NOT NULL AND r IS NOT NULL AND abs(r - xr) > 0.00001 THEN 'return_for_entain_formula' END,
  CASE WHEN first_row <> source_row_number THEN 'bet_id_unique' END,
  CASE WHEN customer_id <> '' AND p_num IS NOT NULL AND first_same <> source_row_number THEN 'customer_bet_num_unique' END,
  CASE WHEN gid IS NOT NULL AND p_num > 0 THEN 'customer_bet_num_sequence' END], lambda e: e IS NOT NULL)) AS errors FROM w)
"""
_COUNTS = _PARSED + "SELECT rule, CAST(count(*) AS BIGINT) AS failures FROM (SELECT unnest(errors) AS rule FROM x) GROUP BY rule"


def _features_sql(n: int) -> str:
    total = lambda c: f"CAST(sum(CAST({c} AS DECIMAL(30,8))) AS DOUBLE)"
    return _PARSED + f"""SELECT customer_id, arg_min(p_ts, (p_num, p_ts, p_id)) AS first_bet_datetime, arg_min(p_ts, (p_num, p_ts, p_id)) FILTER (WHERE p_num = {n}) AS bet_{n}_datetime,
  CAST(count(*) AS BIGINT) AS bets_used, {total("a")} AS total_betting_amount, round({total("a")} / count(*), 12) AS mean_betting_amount, round({total("q")} / count(*), 12) AS mean_price,
  round(count(*) FILTER (WHERE category = 'racing') / count(*), 12) AS pct_racing, round(count(*) FILTER (WHERE stake_type = 'cash') / count(*), 12) AS pct_cash, round(count(*) FILTER (WHERE bet_result = 'return') / count(*), 12) AS pct_return,
  {total("o")} AS total_payout, {total("r")} AS total_return_for_entain FROM x WHERE len(errors) = 0 AND p_num <= {n} GROUP BY customer_id"""


#: The digest's eight words of eight digits, taken modulo the count one after the other.
_DIGEST = "0"
for _i in range(8):
    _DIGEST = f"(({_DIGEST}) * 4294967296 + CAST('0x' || substr(sha256(customer_id), {1 + 8 * _i}, 8) AS BIGINT)) % {BUCKETS}"

# of the rules across rows, library mode flags all copies, and the first number rule of a row only
_ACROSS = ", ".join(f"'{r}'" for r in ("bet_id_unique", "customer_bet_num_unique", "customer_bet_num_sequence"))
_LIBRARY = _PARSED + f""", y AS (SELECT *, count(*) OVER (PARTITION BY bet_id) AS copies, count(*) OVER (PARTITION BY customer_id, bet_num) AS twins FROM x),
n AS (SELECT customer_id AS nid, count(DISTINCT p_num) AS nums, max(p_num) AS most, min(p_num) AS least FROM x GROUP BY 1),
z AS (SELECT source_row_number, list_sort(list_concat(list_filter(errors, lambda e: e NOT IN ({_ACROSS})), list_filter([
  CASE WHEN bet_id <> '' AND p_id IS NOT NULL AND copies > 1 THEN 'bet_id_unique' END,
  CASE WHEN p_num >= 1 AND twins > 1 THEN 'customer_bet_num_unique'
       WHEN p_num >= 1 AND bet_num = CAST(p_num AS VARCHAR) AND (nums <> most OR least < 1) THEN 'customer_bet_num_sequence' END], lambda e: e IS NOT NULL))) AS errors FROM y JOIN n ON nid = customer_id)
SELECT source_row_number, array_to_string(errors, '|') AS validation_errors FROM z"""

ORACLE_SQL = {
    "bronze_projection": DERIVED_SQL,
    "annotated_errors": _PARSED + "SELECT source_row_number, array_to_string(errors, '|') AS validation_errors FROM x",
    "valid_bets": _PARSED + "SELECT p_id AS bet_id, customer_id, p_ts AS bet_datetime, p_num AS bet_num, CAST(a AS DOUBLE) AS betting_amount, CAST(q AS DOUBLE) AS price, category, stake_type, bet_result, CAST(o AS DOUBLE) AS payout, CAST(r AS DOUBLE) AS return_for_entain, source_row_number FROM x WHERE len(errors) = 0",
    "invalid_bets": _PARSED + f"SELECT {', '.join(rules.COLUMNS)}, source_row_number, array_to_string(errors, '|') AS validation_errors FROM x WHERE len(errors) > 0",
    "failure_counts": _COUNTS,
    "failures_ranked": _COUNTS + " ORDER BY failures DESC, rule",
    "validation_totals": _PARSED + "SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(*) FILTER (WHERE len(errors) = 0) AS BIGINT) AS valid_rows, CAST(count(*) FILTER (WHERE len(errors) > 0) AS BIGINT) AS invalid_rows FROM x",
    "first_occurrence": _PARSED + "SELECT fid AS bet_id, first_row, CAST(occurrences AS BIGINT) AS occurrences FROM firsts",
    "sequence_gaps": _PARSED + "SELECT gid AS customer_id, CAST(distinct_nums AS BIGINT) AS distinct_nums, last_num FROM gaps",
    "customer_features_n20": _features_sql(20),
    "customer_features_n10": _features_sql(10),
    "incomplete_first_n": f"SELECT CAST(count(*) AS BIGINT) AS customers, CAST(count(*) FILTER (WHERE bets_used < 20) AS BIGINT) AS customers_with_incomplete_first_n FROM ({_features_sql(20)})",
    "library_mode_errors": _LIBRARY,
    "hash_partition_counts": f"WITH raw AS ({DERIVED_SQL}), c AS (SELECT customer_id, {_DIGEST} AS bucket, count(*) AS bets FROM raw GROUP BY ALL) SELECT CAST(bucket AS INTEGER) AS bucket, CAST(count(*) AS BIGINT) AS customers, CAST(sum(bets) AS BIGINT) AS bets FROM c GROUP BY bucket",
    "source_row_resolution": f"SELECT min(source_row_number) AS first_row, max(source_row_number) AS last_row, CAST(count(DISTINCT source_row_number) AS BIGINT) AS total_rows FROM ({DERIVED_SQL})",
    "failure_combinations": _PARSED + "SELECT array_to_string(errors, '|') AS validation_errors, CAST(count(*) AS BIGINT) AS total_rows FROM x WHERE len(errors) > 0 GROUP BY 1",
} | {f"rule_{rule}": _PARSED + f"SELECT source_row_number FROM x WHERE list_contains(errors, '{rule}')" for rule in RULES}
ORACLE_SQL |= {f"csv_{name}": ORACLE_SQL[same] for name, same in (("raw_bets", "bronze_projection"), ("valid_bets", "valid_bets"), ("invalid_bets", "invalid_bets"), ("customer_features", "customer_features_n20"), ("failure_counts", "failure_counts"))}
