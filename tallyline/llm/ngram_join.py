"""Similarity join of documents on word n-grams, by Jaccard similarity.

Documents with equal n-gram sets form a class, which takes part once. A class's n-grams are ordered rare
first; two classes at or above the threshold share one of their first n - ceil(t n) + 1 (the prefix).
Candidates from prefixes pass a length filter, a positional filter and a suffix filter (an upper bound
of the overlap from counts of n-grams by ranges of their hash), and each pair is verified once on the
whole sets.

Frequencies come from a table of fixed size with hashed entries, counted over all documents. Any total
order keeps the join exact; the table only has to tell common n-grams from rare ones.

Large groups of near copies aren't joined pair by pair. Members of a posting list are first compared
with three centres of the list, and components are formed; then only pairs of different components are
compared, all that may be similar. Pairs inside a component can't change the components.

N-grams are 64-bit hashes, classes 64-bit digests of the sorted sets.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import cut, drop, maybe, pieces, settled, size as rows_of
from tallyline.llm.components import components

#: log2 of the entries of the frequency table, of its parts, and of the bits of the filter for texts.
TABLE_BITS = 22
PART_BITS = 16
FILTER_BITS = 23
#: Ranges of the hash that the suffix filter counts.
RANGES = 64
MEMO_ENTRIES = 150_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str | None, size: int, words: _Words) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-grams of ASCII-lower-cased words; of fewer words, one."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = (out ^ h[i : len(h) - n + 1 + i]) * _A
        out ^= out >> np.uint64(31)
        out *= _B
    return np.unique(out ^ (out >> np.uint64(29)))


def frequencies(docs: DataFrame, text: str, size: int, bits: int = TABLE_BITS) -> np.ndarray:
    """Numbers of documents by the upper ``bits`` of their n-grams' hashes, over all documents.

    Each task counts its documents; parts of the counts are added up where they meet.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total, waiting, held = _Words(), np.zeros(1 << bits, dtype=np.uint32), [], 0
        for batch in batches:
            for part in pieces(batch, "text"):
                for value in part.column("text").to_pylist():
                    waiting.append((shingles(value, size, words) >> np.uint64(64 - bits)).astype(np.int32))
                    held += len(waiting[-1])
                if held > 1 << 20:
                    total += np.bincount(np.concatenate(waiting), minlength=1 << bits).astype(np.uint32)
                    waiting, held = [], 0
        if held:
            total += np.bincount(np.concatenate(waiting), minlength=1 << bits).astype(np.uint32)
        for i in range(1 << max(0, bits - PART_BITS)):
            piece = total[i << PART_BITS : (i + 1) << PART_BITS]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(piece.tobytes(), 1)], pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for i, data in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                piece = np.frombuffer(zlib.decompress(data), dtype=np.uint32)
                if i != now:
                    if total is not None:
                        yield row(now, total)
                    now, total = i, np.zeros(len(piece), dtype=np.uint32)
                total += piece
        if total is not None:
            yield row(now, total)

    def row(i: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "counts"])

    schema = "part int, counts binary"
    parts = docs.select(F.col(text).alias("text")).where("text is not null").mapInArrow(count, schema)
    out = np.zeros(1 << bits, dtype=np.uint32)
    for r in parts.repartition("part").sortWithinPartitions("part").mapInArrow(add, schema).collect():
        piece = np.frombuffer(r["counts"], dtype=np.uint32)
        out[r["part"] << PART_BITS : (r["part"] << PART_BITS) + len(piece)] = piece
    return out


def described(docs: DataFrame, key: str, text: str, size: int, percent: int, bits: int = TABLE_BITS) -> DataFrame:
    """Every row's ``key``, class ``cls`` (null without words), set size ``n``, ``hist`` and ``prefix``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies(docs, text, size, bits))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = _Words(), shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                classes, sizes, hists, prefixes = [], [], [], []
                for value in part.column("text").to_pylist():
                    s = shingles(value, size, words)
                    n = len(s)
                    classes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if n else None)
                    sizes.append(n)
                    hists.append(np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=RANGES).astype("<u4").tobytes())
                    order = np.lexsort((s, table[(s >> np.uint64(64 - bits)).astype(np.int64)]))
                    prefixes.append(s[order[: n + (-percent * n // 100) + 1]].view(np.int64) if n else np.empty(0, dtype=np.int64))
                offsets = np.cumsum([0, *map(len, prefixes)])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(prefixes)))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(hists, pa.binary()), lists], names=["key", "cls", "n", "hist", "prefix"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, cls long, n long, hist binary, prefix array<long>")


def _sets(docs: DataFrame, key: str, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """``cls, grams`` of the wanted classes (``cls`` and ``rep``, a key that has this class).

    A filter of fixed size with a bit for each wanted key goes to all tasks, so that most other texts
    drop out before they are read closely; a join then removes what passed by chance.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        for batch in batches:
            bits[batch.column("h").to_numpy() & ((1 << FILTER_BITS) - 1)] = True
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], names=["bits"])

    bits = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for r in wanted.select(F.xxhash64("rep").alias("h")).coalesce(64).mapInArrow(mark, "bits binary").toLocalIterator():  # 1 MB each, 64 at most
        bits |= np.frombuffer(zlib.decompress(r["bits"]), dtype=np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, allowed = _Words(), np.unpackbits(shared.value)
        for batch in batches:
            hit = allowed[batch.column("h").to_numpy() & ((1 << FILTER_BITS) - 1)].astype(bool)
            for part in pieces(batch.filter(pa.array(hit)), "text"):
                grams = [g for value in part.column("text").to_pylist() if len(g := shingles(value, size, words))]
                classes = [xxhash.xxh3_64_intdigest(g.tobytes()) - (1 << 63) for g in grams]
                yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array([g.tobytes() for g in grams], pa.binary())], names=["cls", "grams"])

    found = docs.select(F.xxhash64(key).alias("h"), F.col(text).alias("text")).where("text is not null").mapInArrow(run, "cls long, grams binary")
    return found.join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def _verified(docs: DataFrame, key: str, text: str, size: int, percent: int, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of classes at or above the threshold, each checked once."""
    facts = classes.select("cls", "n", "hist")
    left, right = (facts.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("hist").alias(f"hist_{c}")) for c in "ab")
    full = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "n_a", "n_b", "hist_a", "hist_b")

    def suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(-1, RANGES) for c in ("hist_a", "hist_b"))
                most = np.minimum(one, two).sum(axis=1).astype(np.int64)
                n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
                keep = 100 * most >= percent * (n - most)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    likely = cut(full.mapInArrow(suffix, "a long, b long"), packed=True)
    wanted = likely.select(F.col("a").alias("cls")).unionByName(likely.select(F.col("b").alias("cls"))).distinct()
    sets = _sets(docs, key, text, size, cut(wanted.join(classes.select("cls", "rep"), "cls")))
    both = likely.join(sets.select(F.col("cls").alias("b"), F.col("grams").alias("grams_b")).hint("merge"), "b").join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("grams_a")).hint("merge"), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "grams_b"):
                keep, last, first = [], None, None
                for one, two in zip(part.column("grams_a"), part.column("grams_b").to_pylist()):
                    data = one.as_py()
                    if data != last:
                        last, first = data, np.frombuffer(data, dtype=np.uint64)
                    second = np.frombuffer(two, dtype=np.uint64)
                    at = np.minimum(np.searchsorted(first, second), len(first) - 1)
                    common = int((first[at] == second).sum())
                    keep.append(100 * common >= percent * (len(first) + len(second) - common))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    return both.select("a", "b", "grams_a", "grams_b").mapInArrow(check, "a long, b long")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """Every row's ``key``, ``n_shingles`` (set size) and ``component_id``.

    Two documents link when 100 times the intersection is at least ``percent`` times the union of their
    sets of ``size``-grams. ``component_id`` is the smallest key reachable by links, the row's own if
    it has none (also for null and empty texts, which have empty sets). A class whose keys are all null
    has a null id. Repeated rows have equal results; other columns are ignored.
    """
    return settled(lambda: _join(docs, key, text, size, percent), packed=True)


def _join(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    every = cut(described(docs, key, text, size, percent), packed=True)
    classes = cut(every.where("cls is not null").groupBy("cls").agg(F.min("key").alias("rep"), F.first("n").alias("n"), F.first("hist").alias("hist")), packed=True)
    band = F.floor(F.log("n") / math.log(100 / percent)).cast("int")  # sizes in proportion differ by 1 at most
    raw = every.where("cls is not null").select("cls", "n", band.alias("band"), F.posexplode("prefix").alias("pos", "gram"))
    # grams of one class are most; they are left out before the others are shuffled
    shared = cut(raw.groupBy("gram").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).where("least <> most").select("gram"), packed=True)
    entries = cut(maybe(raw, shared, "gram", rows_of(shared)).join(shared.hint("merge"), "gram").distinct(), packed=True)
    drop(shared)

    def likely(n1, p1, n2, p2):
        """Length and positional filter: sizes in proportion, and enough n-grams from the match on.

        The first n-gram that two sets share has none in common before it; later ones have less behind
        them. So a similar pair passes at its first one.
        """
        return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (F.least(n1 - p1, n2 - p2) * (100 + percent) >= (n1 + n2) * percent)

    def with_centre(rows: DataFrame, centres: list[str]) -> DataFrame:
        """Pairs of a list's members with its centres, once."""
        found = rows.select("cls", "n", "pos", F.explode(F.array(*centres)).alias("c")).where("cls <> c.cls")
        found = found.where(likely(F.col("n"), F.col("pos"), F.col("c.n"), F.col("c.pos")))
        return found.select(F.col("c.cls").alias("a"), F.col("cls").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    ends = entries.groupBy("gram", "band").agg(F.min(F.struct("pos", "n", "cls")).alias("low"), F.max(F.struct("n", "cls", "pos")).alias("high"), F.min(F.struct(F.xxhash64("cls").alias("h"), "pos", "n", "cls")).alias("any")).where("low.cls <> high.cls")
    central = entries.join(ends.hint("merge"), ["gram", "band"]).withColumns({c: F.struct(f"{c}.pos", f"{c}.n", f"{c}.cls") for c in ("high", "any")})
    links = settled(lambda: _verified(docs, key, text, size, percent, with_centre(central, ["low", "high", "any"]), classes))
    groups = settled(lambda: components(links))

    named = entries.join(groups.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    mixed = named.groupBy("gram").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("gram")
    named = cut(named.join(mixed.hint("merge"), "gram", "left_semi"), packed=True)
    drop(entries)
    by_group = named.groupBy("gram", "band", "component").agg(F.max(F.col("n") - F.col("pos")).alias("rest"), F.min("n").alias("n"))
    one = by_group.select("gram", F.col("band").alias("b1"), F.col("component").alias("c1"), F.col("rest").alias("r1"), F.col("n").alias("n1"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("b2"))
    two = by_group.select("gram", F.col("band").alias("b2"), F.col("component").alias("c2"), F.col("rest").alias("r2"), F.col("n").alias("n2"))
    far = F.least("r1", "r2") * (100 + percent) >= (F.col("n1") + F.col("n2")) * percent  # some two members may pass
    met = one.join(two.hint("merge"), ["gram", "b2"]).where((F.col("c1") < F.col("c2")) & far).select("gram", "b1", "c1", "b2", "c2")
    first, second = (named.select("gram", F.col("band").alias(f"b{i}"), F.col("component").alias(f"c{i}"), *(F.col(x).alias(f"{x}_c{i}") for x in ("cls", "n", "pos"))) for i in (1, 2))
    rows = met.join(first.hint("merge"), ["gram", "b1", "c1"]).join(second.hint("merge"), ["gram", "b2", "c2"]).where(likely(F.col("n_c1"), F.col("pos_c1"), F.col("n_c2"), F.col("pos_c2")))
    pairs = rows.select(F.least("cls_c1", "cls_c2").alias("a"), F.greatest("cls_c1", "cls_c2").alias("b")).distinct()
    groups = settled(lambda: components(links.unionByName(_verified(docs, key, text, size, percent, pairs, classes))))
    member = classes.select("cls", "rep").join(groups.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = member.join(smallest, "component").select("cls", "component_id")
    return every.select("key", "n", "cls").join(named, "cls", "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"))
