"""Partitions that hold every row of a customer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket(key: Column, count: int) -> Column:
    """The SHA-256 of ``key``, as one number, modulo ``count``: eight digits at a time."""
    digest = F.sha2(key, 256)
    words = (F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(8))
    return reduce(lambda rest, word: (rest * F.lit(1 << 32) + word) % F.lit(count), words, F.lit(0).cast("bigint")).cast("int")


def partition_count(fixed: int | None, target_rows: int, total_rows: int) -> int:
    """The count asked for, or as many as hold about ``target_rows`` each."""
    if fixed is not None:
        if fixed < 1:
            raise ValueError("feature partition count must be greater than 0")
        return fixed
    if target_rows < 1:
        raise ValueError("target feature partition rows must be greater than 0")
    return max(1, -(-total_rows // target_rows))


def customer_complete(rows: DataFrame, count: int, order: str) -> DataFrame:
    """``rows`` in ``count`` partitions by customer, sorted within each."""
    return rows.repartitionById(count, bucket(F.col("customer_id"), count)).sortWithinPartitions(order)
