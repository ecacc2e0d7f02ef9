"""Byte-level BPE with a two-tier lookup.

Whole pre-tokens that are vocabulary entries are resolved by a minimal perfect hash; the others are
merged pair by pair with a heap over a linked list of byte spans, in O(n log n) for n bytes. Ids are
those of the public rank-file format: the lowest rank merges first, the leftmost of equals.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import kept, pieces

#: Distinct pre-tokens whose ids a worker remembers, and characters of those at most: longer ones are
#: encoded anew each time, so the memory has a bound in bytes. It is emptied when full.
MEMO_ENTRIES = 250_000
MEMO_LENGTH = 40


def load_ranks(path: str) -> list[bytes]:
    """Vocabulary of a rank file (one base64 token and its rank a line), by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    vocabulary: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        vocabulary[int(rank)] = base64.b64decode(token)
    return vocabulary


class PerfectHash:
    """Minimal perfect hash of a fixed set of byte strings by hash, bucket and displacement.

    n keys take exactly n slots. Keys fall into about n/4 buckets; large buckets come first and each
    searches the seed that sends its keys to free slots; a bucket of one key names its slot outright.
    """

    def __init__(self, keys: list[bytes], seeds: list[int] | None = None, slots: list[int] | None = None):
        self.size = n = len(keys)
        self.buckets = max(1, n // 4)
        self.keys = keys
        if seeds is not None and slots is not None:  # built before
            self.seeds, self.slots = seeds, slots
            return
        self.seeds = [0] * self.buckets
        self.slots: list[int] = [-1] * n
        grouped: list[list[int]] = [[] for _ in range(self.buckets)]
        for index, key in enumerate(keys):
            grouped[xxhash.xxh3_64_intdigest(key) % self.buckets].append(index)
        free = None
        for bucket in sorted(range(self.buckets), key=lambda b: -len(grouped[b])):
            members = grouped[bucket]
            if not members:
                break
            if len(members) == 1:
                if free is None:
                    free = (slot for slot in range(n) if self.slots[slot] < 0)
                slot = next(free)
                self.slots[slot] = members[0]
                self.seeds[bucket] = -slot - 1
                continue
            seed = 1
            while True:
                spots = [xxhash.xxh3_64_intdigest(keys[m], seed) % n for m in members]
                if len(set(spots)) == len(spots) and all(self.slots[s] < 0 for s in spots):
                    break
                seed += 1
            self.seeds[bucket] = seed
            for spot, member in zip(spots, members):
                self.slots[spot] = member

    def get(self, key: bytes) -> int | None:
        """Index of ``key`` among the keys, or None for any other string."""
        if not self.size:
            return None
        seed = self.seeds[xxhash.xxh3_64_intdigest(key) % self.buckets]
        slot = -seed - 1 if seed < 0 else xxhash.xxh3_64_intdigest(key, seed) % self.size
        found = self.slots[slot]
        return found if self.keys[found] == key else None


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token that is no vocabulary entry."""
    n = len(piece)
    ends = list(range(1, n + 1))  # of the span that starts here; 0 once it is merged away
    before = list(range(-1, n - 1))  # start of the span to the left
    get, push, pop = ranks.get, heapq.heappush, heapq.heappop
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, start, end = pop(heap)
        middle = ends[start]
        if not middle or middle >= n or ends[middle] != end:
            continue  # one of the two spans has been merged since
        ends[start], ends[middle] = end, 0
        if end < n:
            before[end] = start
            if (rank := get(piece[start : ends[end]])) is not None:
                push(heap, (rank, start, ends[end]))
        left = before[start]
        if left >= 0 and (rank := get(piece[left:end])) is not None:
            push(heap, (rank, left, end))
    ids, start = [], 0
    while start < n:
        ids.append(ranks[piece[start : ends[start]]])
        start = ends[start]
    return ids


class _Memo(dict):
    """Ids by pre-token, as they are first met."""

    def __init__(self, vocabulary: list[bytes], whole: PerfectHash):
        self.whole = whole
        self.ranks = {token: rank for rank, token in enumerate(vocabulary)}

    def __missing__(self, token: str) -> tuple[int, ...]:
        piece = token.encode("utf-8")
        rank = self.whole.get(piece)
        ids = (rank,) if rank is not None else tuple(merge(piece, self.ranks))
        if len(token) <= MEMO_LENGTH:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[token] = ids
        return ids


def encode(df: DataFrame, key: str, text: str, vocabulary: list[bytes], pattern: str, back: bool = False) -> DataFrame:
    """``key`` and ``ids array<int>`` of every row; a null text counts as empty and has no ids.

    With ``back``, a third column ``decoded`` holds the bytes that the ids stand for. Every row has
    its own result: repeated rows and keys stay, null keys are kept, other columns are not returned.
    A text of any length is encoded whole. The vocabulary has a fixed size and is broadcast with its
    hash; a worker process keeps both for its next tasks.
    """
    whole = PerfectHash(vocabulary)
    shared = df.sparkSession.sparkContext.broadcast((vocabulary, whole.seeds, whole.slots))
    kind = df.schema[key].dataType
    name = "bpe", hashlib.sha256(b"\0".join(vocabulary)).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        def build() -> _Memo:
            tokens, seeds, slots = shared.value
            return _Memo(tokens, PerfectHash(tokens, seeds, slots))

        memo, find = kept(name, build), regex.compile(pattern).findall
        token = memo.whole.keys.__getitem__
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                values, offsets, decoded = [], [0], []
                for value in part.column("text").to_pylist():
                    ids = list(chain.from_iterable(map(memo.__getitem__, find(value)))) if value else []
                    values.append(np.array(ids, dtype=np.int32))
                    offsets.append(offsets[-1] + len(ids))
                    if back:
                        decoded.append(b"".join(map(token, ids)))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(values)))
                columns = [part.column("key"), lists, *([pa.array(decoded, pa.binary())] if back else [])]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "ids", "decoded"][: len(columns)])

    schema = f"`{key}` {kind.simpleString()}, ids array<int>" + ", decoded binary" * back
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def decode(df: DataFrame, ids: str, vocabulary: list[bytes]) -> DataFrame:
    """The rows of ``df`` with a binary column ``decoded``: the bytes that ``ids`` stand for."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                lists = part.column(names.index(ids))
                flat, offsets = lists.values.to_numpy().tolist(), lists.offsets.to_pylist()
                out = [b"".join(map(token, flat[a:b])) for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*names, "decoded"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), "decoded binary"])
    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, key: str, text: str, vocabulary: list[bytes], pattern: str) -> DataFrame:
    """Per row: the number of ids, the digest of the ids and that of the text decoded from them."""
    return encode(df, key, text, vocabulary, pattern, back=True).select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
