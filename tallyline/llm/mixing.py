"""Mixing sources to target weights.

The words of a source, document after document in a pseudorandom order, are packed into blocks of a
fixed length. Output shards draw how many of their slots each source fills; a source's slots are
numbered on through the shards and mapped to its blocks by pseudorandom permutations of the block
indices, one for each pass over the source. Blocks are joined by index.

Only block indices, sizes and counts move. A running sum over a source is taken in two steps (totals
of hash buckets, then within a bucket), so that no task holds a whole source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating; the share of all sizes that is mixed; passes at most.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
PASSES = 2
#: Words of a block, shards of the output, documents of a hash bucket of a source.
BLOCK = 128
SHARDS = 64
BUCKET = 2_000
SEED = 20_240_801


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], share: float = SHARE, passes: float = PASSES, weights: tuple[float, ...] = WEIGHTS) -> list[float]:
    """Words to take of each source: ``share`` of all sizes by weight, none above ``passes`` sizes.

    What a capped source can't take is shared out again by weight among the others.
    """
    goal = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weights[i % len(weights)] for i in open_)
        per = {i: left * weights[i % len(weights)] / total for i in open_}
        full = [i for i in open_ if per[i] > passes * sizes[i]]
        if not full:
            for i in open_:
                goal[i] = per[i]
            break
        for i in full:
            goal[i] = float(passes * sizes[i])
            left -= goal[i]
        open_ = [i for i in open_ if i not in set(full)]
    return goal


def draw(slots: list[int], shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Slots of each source in each shard (shards x sources), by multinomial draws.

    A shard draws from the sources by the slots that they have left; a draw beyond them is drawn
    again from the others. So each shard is a random mixture and the columns add up to ``slots``.
    """
    left = np.array(slots, dtype=np.int64)
    counts = np.zeros((shards, len(slots)), dtype=np.int64)
    random = np.random.default_rng(seed)
    for shard in range(shards):
        need = int(left.sum()) // (shards - shard)
        while need:
            got = np.minimum(random.multinomial(need, left / left.sum()), left)
            counts[shard] += got
            left -= got
            need -= int(got.sum())
    return counts


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Images of ``index`` under a pseudorandom permutation of 0..size-1 chosen by ``key``, each.

    A four-round Feistel network over the smallest even number of bits that holds ``size``; images
    outside are mapped again until they fall inside.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.int64) + 1) // 2).astype(np.uint64)
    half = np.where(np.left_shift(np.uint64(1), half + half) < size.astype(np.uint64), half + np.uint64(1), half)
    mask = np.left_shift(np.uint64(1), half) - np.uint64(1)
    out, live = index.astype(np.uint64), np.arange(len(index))
    size, key = size.astype(np.uint64), key.astype(np.uint64)
    while len(live):
        h, m, k = half[live], mask[live], key[live]
        left, right = out[live] >> h, out[live] & m
        for turn in range(4):
            mixed = (right + k + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & m)
        out[live] = (left << h) | right
        live = live[out[live] >= size[live]]
    return out.astype(np.int64)


def plan(sizes: DataFrame, share: float = SHARE, passes: int = PASSES, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of documents of given sizes.

    ``sizes`` has a row for each document: ``row`` (its key), ``source``, ``size``. Returns

    * documents: ``row, source, source_index, size, source_size, target``;
    * pieces of documents in blocks: ``row, source_index, block, start, length`` (words);
    * block slots: ``source_index, block, shard, times``.

    Sources are few (their table is collected): names, sizes and counts only. A source without words
    has a target of 0 and no slots; an empty table gives empty results. Reruns agree.
    """
    spark = sizes.sparkSession
    whole = [(r["source"], int(r["size"] or 0), int(r["n"])) for r in sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()]
    whole.sort(key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    goal = targets([x[1] for x in whole], share, passes)
    blocks = [-(-x[1] // block) for x in whole]
    slots = [min(round(g / x[1] * b), passes * b) if x[1] else 0 for g, x, b in zip(goal, whole, blocks)]
    counts = draw(slots, shards, seed)
    buckets = [max(1, -(-x[2] // BUCKET)) for x in whole]

    facts = spark.createDataFrame([(x[0], i, x[1], float(g), n) for i, (x, g, n) in enumerate(zip(whole, goal, buckets))], "source string, source_index int, source_size long, target double, buckets int")
    docs = sizes.join(F.broadcast(facts), sizes["source"].eqNullSafe(facts["source"])).select("row", sizes["source"], "source_index", "size", "source_size", "target", F.pmod(F.xxhash64("row", F.lit(seed)), "buckets").cast("int").alias("bucket"))
    totals = docs.groupBy("source_index", "bucket").agg(F.sum("size").alias("words"))
    in_source = Window.partitionBy("source_index").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("source_index", "bucket", F.coalesce(F.sum("words").over(in_source), F.lit(0)).alias("base"))
    in_bucket = Window.partitionBy("source_index", "bucket").orderBy(F.xxhash64("row", F.lit(seed + 1)), "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.where("size > 0").withColumn("inner", F.coalesce(F.sum("size").over(in_bucket), F.lit(0))).join(starts, ["source_index", "bucket"])
    first = F.col("base") + F.col("inner")
    spans = placed.select("row", "source_index", "size", first.alias("first"), F.explode(F.sequence(F.floor(first / block), F.floor((first + F.col("size") - 1) / block))).alias("block"))
    begin, end = F.greatest(F.col("first"), F.col("block") * block), F.least(F.col("first") + F.col("size"), (F.col("block") + 1) * block)
    cutting = spans.select("row", "source_index", "block", (begin - F.col("first")).alias("start"), (end - begin).alias("length"))

    runs, base = [], np.zeros(len(whole), dtype=np.int64)
    for shard in range(shards):
        for i in np.flatnonzero(counts[shard]).tolist():
            runs.append((i, shard, int(base[i]), int(counts[shard, i]), blocks[i]))
        base += counts[shard]
    drawn = spark.createDataFrame(runs, "source_index int, shard int, base long, slots long, blocks long")
    step = 1 << 16
    drawn = drawn.select("source_index", "shard", "blocks", (F.col("base") + F.col("slots")).alias("stop"), F.explode(F.sequence(F.col("base"), F.col("base") + F.col("slots") - 1, F.lit(step))).alias("begin"))
    return docs.drop("bucket"), cutting, _slots(drawn, step, seed, min(4096, max(8, sum(slots) >> 17)))


def _slots(drawn: DataFrame, step: int, seed: int, tasks: int) -> DataFrame:
    """Slots of every run of at most ``step`` (``source_index, shard, blocks, stop, begin``), as blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                slot = np.arange(r["begin"], min(r["stop"], r["begin"] + step), dtype=np.int64)
                size = np.full(len(slot), r["blocks"], dtype=np.int64)
                lap, index = np.divmod(slot, size)
                key = (lap + 1) * 1_000_003 + r["source_index"] * 7_919 + seed
                got, times = np.unique(permuted(index, size, key), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), r["source_index"], dtype=np.int32)), pa.array(got), pa.array(np.full(len(got), r["shard"], dtype=np.int32)), pa.array(times.astype(np.int64))], names=["source_index", "block", "shard", "times"])

    return drawn.repartition(tasks, F.xxhash64("source_index", "shard", "begin")).mapInArrow(run, "source_index int, block long, shard int, times long")


def taken(pieces: DataFrame, slots: DataFrame) -> DataFrame:
    """Pieces joined with their blocks' slots by index: ``row, start, length, times`` (at least 1)."""
    often = slots.groupBy("source_index", "block").agg(F.sum("times").alias("times"))
    return pieces.join(often.hint("merge"), ["source_index", "block"]).select("row", "start", "length", "times")


def rows(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """``key, source, size`` and a ``row`` key that tells repeated rows of a key apart, with the row as ``whole``.

    Repeats of a key are numbered by source, size and a hash of the text; so the number only orders equal
    rows. Rows of a null key, of which there may be many, are told apart by source, size and hash alone
    and numbered within those.
    """
    named = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), words(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("hash"), F.struct(*(docs[c] for c in docs.columns)).alias("whole"))
    spread = F.when(F.col("key").isNull(), F.xxhash64("source", "size", "hash")).otherwise(0)
    named = named.withColumn("spread", spread)
    again = Window.partitionBy("key", "spread").orderBy("source", "size", "hash")
    return named.withColumn("copy", F.row_number().over(again)).withColumn("row", F.struct("key", "spread", "copy")).select("key", "source", "size", "row", "whole")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``key, size, source_size, target, taken`` of every row; see the module's text.

    A null text has no words; a null source is a source of its own, the last; repeated rows count and
    are taken each for itself. Other columns are ignored.
    """
    sizes = cut(rows(docs, key, text, source).select("row", "source", "size"))
    documents, cutting, slots = plan(sizes, **options)
    per_row = taken(cutting, slots).groupBy("row").agg(F.sum(F.col("length") * F.col("times")).alias("taken"))
    return documents.join(per_row, "row", "left").select(F.col("row.key").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def materialise(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", length: str = "n_chars", **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for each pass that takes words of a document.

    The first row holds the words of all blocks that are taken at least once, the second those taken
    twice, and so on; whole documents keep their text as it is, of others the words of the blocks
    stand with single blanks between. Documents of which nothing is taken have no row. Other columns,
    whatever their names, keep their values.
    """
    keyed = rows(docs, key, text, source)
    sizes = cut(keyed.select("row", "source", "size"))
    _, cutting, slots = plan(sizes, **options)
    got = taken(cutting, slots).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length", "times"))).alias("blocks"))
    got = got.select(*(F.col(f"row.{c}").alias(f"r_{c}") for c in ("key", "spread", "copy")), "blocks")
    same = F.col("row.key").eqNullSafe(F.col("r_key")) & (F.col("row.spread") == F.col("r_spread")) & (F.col("row.copy") == F.col("r_copy"))
    marked = keyed.join(got.hint("merge"), same).select("whole", F.col("whole")[text].alias("text"), "size", "blocks")
    turns = marked.withColumn("turn", F.explode(F.sequence(F.lit(1), F.array_max("blocks.times").cast("int"))))
    turns = turns.withColumn("chosen", F.filter("blocks", lambda b: b["times"] >= F.col("turn")))
    held = F.aggregate("chosen", F.lit(0).cast("long"), lambda s, b: s + b["length"])
    tokens = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    some = F.array_join(F.flatten(F.transform("chosen", lambda b: F.slice(tokens, (b["start"] + 1).cast("int"), b["length"].cast("int")))), " ")
    out = turns.withColumn("text", F.when(held == F.col("size"), F.col("text")).otherwise(some))
    put = {text: F.col("text")} | ({length: F.length("text").cast(docs.schema[length].dataType)} if length in docs.columns else {})
    return out.select(*(put.get(c, F.col("whole")[c]).alias(c) for c in docs.columns))
