"""One feature row per customer over its first N bets, by bet number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Measures of a feature row, in order.
MEASURES = ["bets_used", "total_betting_amount", "mean_betting_amount", "mean_price", "pct_racing", "pct_cash", "pct_return", "total_payout", "total_return_for_entain"]


def build_features(valid: DataFrame, n: int = 20) -> DataFrame:
    """Features of valid bets with ``bet_num <= n``; later bets never fill up for missing ones."""
    if n < 1:
        raise ValueError("first-N must be at least 1")
    key = F.struct("bet_num", "bet_datetime", "bet_id")
    count = F.count(F.lit(1))

    def total(c: str, per: Column | None = None) -> Column:
        """Exact where a decimal holds every value and the sum, else a sum of doubles; no value is left out."""
        held = F.bool_and(F.coalesce(F.col(f"e_{c}").cast("double") == F.col(c), F.col(c).isNull()))
        exact, rough = F.try_sum(f"e_{c}"), F.sum(c)
        if per is not None:
            exact, rough = exact / per.cast("decimal(10,0)"), rough / per
        return F.coalesce(F.when(held, exact.cast("double")), rough)

    mean = lambda c: total(c, count)
    share = lambda c, v: F.count_if(F.col(c) == v) / count
    money = ("betting_amount", "price", "payout", "return_for_entain")
    rows = valid.where(F.col("bet_num") <= n).withColumns({f"e_{c}": F.col(c).try_cast("decimal(38,18)") for c in money})
    return rows.groupBy("customer_id").agg(
        F.min_by("bet_datetime", key).alias("first_bet_datetime"),
        F.min_by("bet_datetime", F.when(F.col("bet_num") == n, key)).alias(f"bet_{n}_datetime"),
        count.alias("bets_used"),
        total("betting_amount").alias("total_betting_amount"),
        mean("betting_amount").alias("mean_betting_amount"),
        mean("price").alias("mean_price"),
        share("category", "racing").alias("pct_racing"),
        share("stake_type", "cash").alias("pct_cash"),
        share("bet_result", "return").alias("pct_return"),
        total("payout").alias("total_payout"),
        total("return_for_entain").alias("total_return_for_entain"),
    )


def completeness(features: DataFrame, n: int) -> DataFrame:
    return features.agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("bets_used") < n).alias("customers_with_incomplete_first_n"))
