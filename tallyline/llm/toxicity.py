"""Toxic passages as maximum-scoring segments.

Tokens get the log-odds of toxic against other labelled documents under an informative Dirichlet prior
(the pooled counts). All maximal scoring segments of a text are found in one linear scan. Under random
text the best of n tokens follows an extreme-value law, P(S >= s) = 1 - exp(-K n exp(-lambda s)); its
parameters come from the untoxic training rows, and a text's score is a logistic function of the
evidence of its significant segments in those units. The weight of the prior and the significance of a
token are chosen within the training rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import cut, pieces

#: Labelled rows to learn from at most; they bound the token table too.
ROWS = 20_000
#: Weights of the pooled prior in tokens, and least sizes of z from which a token has a score of its own:
#: training chooses among them. What each token has besides the prior.
PRIORS = (100.0, 500.0, 2000.0)
SIGNIFICANT = (2.0, 3.0, 4.0)
FLOOR = 0.5
#: All other tokens share the log ratio of their common share, which is this at most.
REST = -0.01
#: Scores of untoxic tokens are counted by steps of this size.
STEP = 0.01
#: Expected number of segments by chance, below which one is significant.
E_VALUE = 0.05
#: Lengths of the word beginnings that a word unknown to the table falls back on.
STEMS = (8, 6, 5)
MEMO_ENTRIES = 150_000
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    tokens: dict[str, float]
    rest: float
    rate: float  # lambda
    scale: float  # ln K
    bias: float
    slope: float


class _Scores(dict):
    """Score by word, as they are first met."""

    def __init__(self, tokens: dict[str, float], rest: float):
        self.tokens, self.rest = tokens, rest

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        found = self.tokens.get(word)
        for length in STEMS if found is None else ():
            if len(word) > length and (found := self.tokens.get(word[:length] + "*")) is not None:
                break
        self[word] = found = self.rest if found is None else found
        return found


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order, in time linear in the tokens."""
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    breaks = np.flatnonzero(np.diff(up) > 1)
    starts, ends = up[np.concatenate([[0], breaks + 1])], up[np.concatenate([breaks, [len(up) - 1]])] + 1
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sums before and after, last one before with a smaller left sum
    for start, end in zip(starts.tolist(), ends.tolist()):
        left, right = float(sums[start]), float(sums[end])
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
            j = len(found) - 1
        found.append((start, end, left, right, j))
    return [(s, e, r - l) for s, e, l, r, _ in found]


def _scan(text: str, scores: _Scores) -> tuple[int, np.ndarray]:
    tokens = WORD.findall(text.lower())
    return len(tokens), np.fromiter(map(scores.__getitem__, tokens), dtype=np.float64, count=len(tokens))


def _evidence(n: int, found: list[tuple[int, int, float]], rate: float, scale: float) -> float:
    """Sum over significant segments, or else the best, of lambda s - ln(K n); -8 at least."""
    units = [rate * s - scale - math.log(max(n, 1)) for _, _, s in found]
    return max(-8.0, min(60.0, max([max(units, default=-8.0), sum(u for u in units if u >= -math.log(E_VALUE))])))


def _root(steps: np.ndarray, counts: np.ndarray) -> float:
    """The positive lambda at which exp(lambda s) of the tokens' scores has mean 1."""
    values, shares = steps * STEP, counts / max(counts.sum(), 1)
    low, high = 1e-3, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        moment = float((shares * np.exp(np.minimum(middle * values, 600))).sum())
        low, high = (low, middle) if moment > 1 else (middle, high)
    return max(low, 0.05) if len(values) and values.max() > 0 else 1.0


def train(sample: DataFrame) -> Model:
    """A model from rows of ``label`` (1: toxic) and ``text``.

    Four of five rows make the token tables, one for each weight of the prior; the fifth sets the law of
    chance and the logistic curve of each choice, and the choice with the least logistic loss there is
    kept. What reaches the driver is bounded by ROWS: tokens, and a few numbers for each text.
    """
    sample = cut(sample.withColumn("part", F.pmod(F.xxhash64("text", F.lit(5)), F.lit(5))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sides = (Counter(), Counter())
                for label, text in zip(part.column("label").to_pylist(), part.column("text").to_pylist()):
                    words = set(WORD.findall(text.lower()))
                    sides[label].update(words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k})
                names = list(sides[0].keys() | sides[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([s[n] for n in names], pa.int64()) for s in sides)], names=["token", "clean", "toxic"])

    counts = sample.where("part > 0").mapInArrow(count, "token string, clean long, toxic long").groupBy("token").agg(F.sum("clean").cast("double").alias("c"), F.sum("toxic").cast("double").alias("t"))
    counts = cut(counts.withColumn("word", ~F.col("token").endswith("*")))
    total = lambda x, when: F.coalesce(F.sum(F.when(when, F.col(x))), F.lit(0.0))
    sums = counts.agg(total("c", F.lit(True)).alias("c"), total("t", F.lit(True)).alias("t"), total("c", F.col("word")).alias("wc"), total("t", F.col("word")).alias("wt")).first()
    nc, nt = sums["c"], sums["t"]
    choices: list[tuple[dict[str, float], float]] = []
    for weight in PRIORS if nc and nt else ():
        prior = FLOOR + F.lit(weight) * (F.col("c") + F.col("t")) / (nc + nt)
        t, c = F.col("t") + prior, F.col("c") + prior
        odds = F.log(t / (nt + weight - t)) - F.log(c / (nc + weight - c))
        marked = counts.select("token", "word", "c", "t", odds.alias("odds"), F.abs(odds / F.sqrt(1 / t + 1 / c)).alias("z")).where(F.col("z") >= min(SIGNIFICANT)).collect()
        for least in SIGNIFICANT:
            kept = [r for r in marked if r["z"] >= least]
            c_left, t_left = (sums[f"w{x}"] - sum(r[x] for r in kept if r["word"]) for x in "ct")
            rest = math.log((t_left + 1) / (sums["wt"] + 1)) - math.log((c_left + 1) / (sums["wc"] + 1))
            choices.append(({r["token"]: r["odds"] for r in kept}, min(REST, rest)))
    choices = choices or [({}, REST)]
    shared = sample.sparkSession.sparkContext.broadcast(choices)  # bounded by the sample

    def scanned(batches: Iterator[pa.RecordBatch], told) -> Iterator[pa.RecordBatch]:
        """``told`` of every text and choice: label, tokens, scores."""
        scores = [_Scores(*x) for x in shared.value]
        for batch in batches:
            for part in pieces(batch, "text"):
                for label, text in zip(part.column("label").to_pylist(), part.column("text").to_pylist()):
                    yield told(label, [_scan(text, s) for s in scores])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best segment of every text; how often each score occurs in the untoxic ones."""
        seen = [Counter() for _ in shared.value]

        def told(label, scans):
            for held, (_, s) in zip(seen, scans) if label == 0 else ():
                held.update(np.rint(s / STEP).astype(np.int64).tolist())
            return label, scans[0][0], [max((x[2] for x in segments(s)), default=0.0) for _, s in scans]

        rows = list(scanned(batches, told))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.int64(), pa.list_(pa.float64())))], names=["label", "n", "best"])
        for i, held in enumerate(seen):
            yield pa.RecordBatch.from_arrays([pa.array([-1 - i], pa.int32()), pa.array([0], pa.int64()), pa.array([[float(x) for pair in held.items() for x in pair]], pa.list_(pa.float64()))], names=["label", "n", "best"])

    fifth = sample.where("part = 0")
    seen = fifth.mapInArrow(look, "label int, n long, best array<double>").collect()
    clean = [r for r in seen if r["label"] == 0]
    laws = []
    for i in range(len(choices)):
        held = Counter()
        for r in seen:
            if r["label"] == -1 - i:
                for step, times in zip(r["best"][::2], r["best"][1::2]):
                    held[step] += times
        rate = _root(np.array(list(held)), np.array(list(held.values())))
        units = [rate * r["best"][i] - math.log(max(r["n"], 1)) for r in clean]
        laws.append((rate, (sum(units) / len(units) if units else 0.0) - 0.5772156649))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = lambda label, scans: (label, [_evidence(n, segments(s), *law) for (n, s), law in zip(scans, laws)])
        rows = list(scanned(batches, told))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], names=["label", "evidence"])

    weighed = fifth.mapInArrow(weigh, "label int, evidence array<double>").collect()
    y = np.array([r["label"] for r in weighed], dtype=float)
    least, model = math.inf, None
    for i, ((tokens, rest), law) in enumerate(zip(choices, laws)):
        x = np.array([r["evidence"][i] for r in weighed])
        bias, slope = _logistic(x, y)
        p = 1 / (1 + np.exp(-np.clip(bias + slope * x, -35, 35)))
        loss = float(-(y * np.log(p) + (1 - y) * np.log1p(-p)).mean()) if len(y) else 0.0
        if loss < least:
            least, model = loss, Model(tokens, rest, *law, bias, slope)
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a logistic curve by Newton's method with a small ridge."""
    w, design = np.array([-2.0, 0.3]), np.stack([np.ones(len(x)), x], axis=1) if len(x) else np.zeros((0, 2))
    for _ in range(50 if len(x) and 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        ridge = np.diag([0.0, 0.1])
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge + np.eye(2) * 1e-9, design.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -1, 1)
    return float(w[0]), max(float(w[1]), 1e-3)


def score(docs: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """``key``, ``score`` (0 to 1) and ``passages`` of every row by its whole text.

    ``passages`` holds the significant toxic segments: word positions, score and expected number by
    chance. A null or empty text has none and the lowest score. Repeated rows and null keys stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        scores = _Scores(m.tokens, m.rest)
        form = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        for batch in batches:
            for part in pieces(batch, "text"):
                out, spans = [], []
                for value in part.column("text").to_pylist():
                    n, s = _scan(value or "", scores)
                    found = segments(s)
                    out.append(m.bias + m.slope * _evidence(n, found, m.rate, m.scale))
                    chance = [(a, b, v, math.exp(min(600.0, m.scale + math.log(max(n, 1)) - m.rate * v))) for a, b, v in found]
                    spans.append([{"start": a, "end": b, "score": v, "expected": e} for a, b, v, e in chance if e <= E_VALUE])
                p = 1 / (1 + np.exp(-np.clip(np.array(out), -35, 35)))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(p), pa.array(spans, form)], names=[key, "score", "passages"])

    schema = f"`{key}` {kind}, score double, passages array<struct<start:int,end:int,score:double,expected:double>>"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def keep(docs: DataFrame, text: str, model: Model, threshold: float) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged and unshuffled.

    Null and empty texts have the lowest score and stay, as do repeated rows; other columns don't matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        scores = _Scores(m.tokens, m.rest)
        for batch in batches:
            for part in pieces(batch, text):
                low = []
                for value in part.column(at):
                    n, s = _scan(value.as_py() or "", scores)
                    x = m.bias + m.slope * _evidence(n, segments(s), m.rate, m.scale)
                    low.append(1 / (1 + math.exp(-max(-35.0, min(35.0, x)))) < threshold)
                yield part.filter(pa.array(low, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
