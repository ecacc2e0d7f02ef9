"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text; where some of its bits are zero, a chunk ends. Ends depend
on the last bytes only, so an insertion moves no far end. Chunks are deduplicated by a 128-bit digest:
the first occurrence (smallest document, then position) stays, runs of repeated chunks are passages.

The rolling hash is evaluated for all positions at once by doubling windows. Digest counts are
aggregated before they are shuffled, so a chunk that most documents share costs one row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import cut, pieces

#: Bits of the hash that are zero at an end (mean chunk of about 2**BITS bytes) and their place: with
#: SHIFT + BITS bytes behind it an end is fixed. Least and most bytes of a chunk.
BITS = 5
SHIFT = 14
LEAST = 12
MOST = 256
#: Bytes that a passage covers at least.
PASSAGE = 96
#: The gear: a pseudorandom word for each byte.
GEAR = np.array([xxhash.xxh3_64_intdigest(bytes([i])) & 0xFFFFFFFF for i in range(256)], dtype=np.uint32)


def ends(data: bytes, bits: int = BITS, gear: np.ndarray = GEAR) -> np.ndarray:
    """Where the chunks of ``data`` end, the last at its length."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.int64)
    h = gear[np.frombuffer(data, dtype=np.uint8)]
    step = 1
    while step < 32 and step < n:  # h[i] covers the last 2 * step bytes
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    hits = np.flatnonzero((h >> np.uint32(SHIFT)) & np.uint32((1 << bits) - 1) == 0) + 1
    hits = hits[np.diff(hits, prepend=-MOST) >= LEAST]  # a hit right behind another one ends nothing
    cuts = np.concatenate([[0], hits[hits < n], [n]])
    gaps = np.diff(cuts)
    if (gaps > MOST).any():
        more = [np.arange(a + MOST, a + g, MOST) for a, g in zip(cuts[:-1][gaps > MOST].tolist(), gaps[gaps > MOST].tolist())]
        cuts = np.unique(np.concatenate([cuts, *more]))
    return cuts[1:]


def chunks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Every chunk of every whole text: ``key, start, length`` (bytes of UTF-8) and its digest ``hi, lo``.

    Null and empty texts have no chunks.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                rows, starts, lengths, digests = [], [], [], []
                for i, value in enumerate(part.column("text").to_pylist()):
                    data = value.encode("utf-8") if value else b""
                    to = ends(data)
                    at = np.concatenate([[0], to[:-1]]) if len(to) else to
                    rows.append(np.full(len(to), i))
                    starts.append(at)
                    lengths.append(to - at)
                    digests.extend(xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(at.tolist(), to.tolist()))
                words = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
                take = pa.array(np.concatenate(rows).astype(np.int32))
                columns = [part.column("key").take(take), *(pa.array(np.concatenate(x).astype(np.int32)) for x in (starts, lengths)), pa.array(words[:, 0].copy()), pa.array(words[:, 1].copy())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "length", "hi", "lo"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("length(text) > 0").mapInArrow(run, f"key {kind}, start int, length int, hi long, lo long")


def repeats(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Chunks that are not the first of their digest: ``key, start, length, keep, keep_start``.

    ``keep`` is the document that holds the first occurrence. Rows that repeat a key and its text are
    one document.
    """
    every = chunks(docs, key, text)
    often = every.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hi", "lo")
    shared = cut(every.join(often.hint("merge"), ["hi", "lo"], "left_semi"))
    first = shared.groupBy("hi", "lo").agg(F.min(F.struct("key", "start")).alias("first"))
    found = shared.join(first.hint("merge"), ["hi", "lo"])
    later = ~(F.col("key").eqNullSafe(F.col("first.key")) & (F.col("start") == F.col("first.start")))
    return found.where(later).select("key", "start", "length", F.col("first.key").alias("keep"), F.col("first.start").alias("keep_start")).distinct()


def passages(docs: DataFrame, key: str, text: str, least: int = PASSAGE) -> DataFrame:
    """Repeated passages of at least ``least`` bytes: runs of repeated chunks that touch.

    ``key, start_byte, end_byte, n_chunks, keep_<key>s`` (the documents that hold the first
    occurrences, smallest first). Documents without such a passage have no row.
    """
    order = Window.partitionBy("key").orderBy("start")
    runs = repeats(docs, key, text).withColumn("fresh", (F.col("start") != F.coalesce(F.lag(F.col("start") + F.col("length")).over(order), F.lit(-1))).cast("int"))
    runs = runs.withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = runs.groupBy("key", "run").agg(F.min("start").alias("start_byte"), F.max(F.col("start") + F.col("length")).alias("end_byte"), F.count(F.lit(1)).alias("n_chunks"), F.array_sort(F.collect_set("keep")).alias(f"keep_{key}s"))
    return whole.where(F.col("end_byte") - F.col("start_byte") >= least).select(F.col("key").alias(key), "start_byte", "end_byte", "n_chunks", f"keep_{key}s")


def without(docs: DataFrame, key: str, text: str, least: int = PASSAGE) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; cuts fall between whole characters."""
    found = passages(docs, key, text, least).groupBy(F.col(key).alias("cut_key")).agg(F.array_sort(F.collect_list(F.struct("start_byte", "end_byte"))).alias("cut_spans"))
    joined = docs.join(found, docs[key].eqNullSafe(found["cut_key"]), "left")

    @F.pandas_udf("string")
    def keep(texts, spans):
        out = []
        for value, cuts in zip(texts, spans):
            if value is not None and cuts is not None:
                data, at, left = value.encode("utf-8"), 0, []
                for x in cuts:
                    left.append(data[at : x["start_byte"]])
                    at = x["end_byte"]
                value = b"".join([*left, data[at:]]).decode("utf-8", "ignore")
            out.append(value)
        return texts.__class__(out, dtype=object)

    return joined.withColumn(text, keep(F.col(text), F.col("cut_spans"))).select(*docs.columns)
