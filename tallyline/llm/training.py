"""Labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text modulo ``modulus``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int, usable: Column, seed: int = 7) -> DataFrame:
    """At most ``rows`` labelled documents as ``key, label, text``, picked by a hash of the key.

    ``usable`` says which keys may be learnt from. Null labels are left out; of repeated labels the
    largest counts, of texts of one key the least. ``rows`` bounds the broadcast as well.
    """
    picked = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).where(usable).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    picked = picked.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(rows)
    found = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(picked), key)
    return found.groupBy(key).agg(F.max("label").alias("label"), F.min("text").alias("text"))
