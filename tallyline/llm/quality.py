"""Quality classifier: logistic regression on hashed word n-grams.

Training is one task over a bounded sample of labelled rows: follow-the-regularised-leader (proximal)
updates, example after example. Scoring is a sparse dot product of each whole text with the weights,
a vector of fixed size.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import pieces

#: log2 of the number of weights; labelled rows to learn from at most; passes over them.
BITS = 18
ROWS = 12_000
EPOCHS = 3
MEMO_ENTRIES = 400_000
TOKEN = re.compile(rb"[a-z0-9\x80-\xff_]+|[^\sa-z0-9\x80-\xff_]+")


class _Ids(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        found = self[token] = xxhash.xxh3_64_intdigest(token)
        return found


def features(text: str, ids: _Ids, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text's word unigrams and bigrams; the squares of the values add up to 1.

    Words and runs of marks are tokens; a token that repeats the one before is a sign of its own.
    """
    tokens = TOKEN.findall(text.encode("utf-8", "replace").lower())
    if not tokens:
        return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.float32)
    one = np.fromiter(map(ids.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    one[1:][one[1:] == one[:-1]] = np.uint64(1)
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ one[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    slots, counts = np.unique(np.concatenate([one * np.uint64(0xD6E8FEB86659FD93), two]) >> np.uint64(64 - bits), return_counts=True)
    return slots.astype(np.int32), np.sqrt(counts / counts.sum()).astype(np.float32)


@dataclass
class Follow:
    """Follow-the-regularised-leader for logistic loss; ``z`` and ``n`` hold a slot for each weight."""

    size: int
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02

    def __post_init__(self):
        self.z, self.n = np.zeros(self.size + 1), np.zeros(self.size + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(slots, self.size), np.append(values, 1.0)
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(sample: DataFrame, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights by slot, the bias last, from rows of ``label`` and ``text``. No rows: all 0.

    Texts become sparse rows before they are shuffled; the one training task keeps them in a
    temporary file of its own, so its memory does not depend on their length.
    """

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = [features(x, ids, bits) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("turn"), pa.array([s.tobytes() for s, _ in rows], pa.binary()), pa.array([v.tobytes() for _, v in rows], pa.binary())], names=["label", "turn", "slots", "vals"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sizes = Follow(1 << bits), []
        with tempfile.TemporaryFile() as kept:
            for batch in batches:
                for label, slots, values in zip(*(batch.column(c).to_pylist() for c in ("label", "slots", "vals"))):
                    kept.write(slots)
                    kept.write(values)
                    sizes.append((label, len(slots) // 4))
            for _ in range(epochs if sizes else 0):
                kept.seek(0)
                for label, n in sizes:
                    model.learn(np.frombuffer(kept.read(4 * n), dtype=np.int32), np.frombuffer(kept.read(4 * n), dtype=np.float32).astype(np.float64), label)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())], names=["weights"])

    rows = sample.select("label", F.xxhash64("text", F.lit(11)).alias("turn"), "text").mapInArrow(sparse, "label int, turn long, slots binary, vals binary")
    found = rows.repartition(1).sortWithinPartitions("turn", "label").mapInArrow(fit, "weights binary").collect()
    return np.frombuffer(found[0]["weights"], dtype=np.float32) if found else np.zeros((1 << bits) + 1, dtype=np.float32)


def score(docs: DataFrame, key: str, text: str, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """``key`` and ``score`` (0 to 1) of every row by its whole text; a null text counts as empty.

    Repeated rows and null keys stay; other columns are not returned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, w = _Ids(), shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                out = []
                for value in part.column("text").to_pylist():
                    slots, values = features(value or "", ids, bits)
                    out.append(float(w[slots] @ values) + float(w[-1]))
                p = 1 / (1 + np.exp(-np.clip(np.array(out), -35, 35)))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(p)], names=[key, "score"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, score double")
