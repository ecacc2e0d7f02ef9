"""Exact top-k search by inner product as a Voronoi kNN join.

Data and queries are grouped by their nearest pivot. A cell's summary (size, radius, smallest distances
to the pivot p) bounds every score in it: q.p - |q| d(v, p) <= q.v <= q.p + |q| R. From the summaries a
query gets a score that k candidates reach for certain, and is sent to the cells whose upper bound
reaches that score, to no others. A cell is searched in blocks, by the tasks of its salts.

Components are integers; scores are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import cut

#: Pivots, vectors of a salt of a cell, vectors of a data block and of a query block.
PIVOTS = 64
SALT = 20_000
BLOCK = 2048
QUERY_BLOCK = 128
#: Queries whose best scores a task keeps before it hands them on.
HELD = 50_000
ROW = "cell int, dist double, id long, width int, dim int, vec binary"


def scaled(vector: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of every component; whole numbers as doubles."""
    return np.floor(np.asarray(vector, dtype=np.float64) * scale)


def _pack(values: np.ndarray) -> tuple[int, bytes]:
    """Bytes a component and the bytes: 4 where all components fit, else 8 (doubles)."""
    if values.size == 0 or np.abs(values).max() < 2**31:
        return 4, values.astype("<i4").tobytes()
    return 8, values.astype("<f8").tobytes()


def _unpack(data: bytes, width: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, dtype="<i4" if width == 4 else "<f8").astype(np.float64).reshape(-1, dim)


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact integer inner products; those beyond 64 bits become the nearest 64-bit number."""
    most = np.abs(queries).max(initial=0.0) * np.abs(data).max(initial=0.0) * max(1, queries.shape[1])
    if most < 2**53:
        return (queries @ data.T).astype(np.int64)
    left, right = [[int(x) for x in row] for row in queries], [[int(x) for x in row] for row in data]
    low, high = -(2**63), 2**63 - 1
    return np.array([[min(high, max(low, sum(a * b for a, b in zip(q, v)))) for v in right] for q in left], dtype=np.int64).reshape(len(left), len(right))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids, in order."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def join(rows: DataFrame, key: str, vector: str, queries, k: int = 10, scale: float = 1024.0, pivots: int = PIVOTS) -> DataFrame:
    """The k candidates with the highest scores of each query: ``query_id, rank, <key>, score``.

    ``queries`` is a condition on the rows; candidates are all rows but those with the query's own
    key. Rows with a null key, and vectors that are null or hold null or non-finite components, take
    no part. A repeated key counts once, with its least vector. A query meets vectors of its own
    length only; with fewer than k candidates it gets them all, with none it has no row.
    """
    spark = rows.sparkSession
    odd = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks")).where(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~odd)
    valid = cut(valid.groupBy("id").agg(F.min("vec").alias("vec"), F.max("asks").alias("asks")))

    chosen = [scaled(r["vec"], scale) for r in valid.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(pivots).select("vec").collect()]
    by_dim: dict[int, list[int]] = {}
    for i, p in enumerate(chosen):
        by_dim.setdefault(len(p), []).append(i)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nearest pivot of the same length; lengths without a pivot have a cell of their own."""
        for batch in batches:
            out: list[tuple] = []
            vectors: dict[int, list] = {}
            for i, v in zip(batch.column("id").to_pylist(), batch.column("vec").to_pylist()):
                vectors.setdefault(len(v), []).append((i, v))
            for dim, own in vectors.items():
                data = scaled(np.array([v for _, v in own], dtype=np.float64).reshape(len(own), dim), scale)
                cells, dist = np.full(len(own), -dim - 1), np.full(len(own), math.inf)
                if dim in by_dim:
                    centres = np.stack([chosen[p] for p in by_dim[dim]])
                    far = np.stack([np.sqrt(((data - c) ** 2).sum(axis=1)) for c in centres], axis=1)
                    near = far.argmin(axis=1)
                    cells, dist = np.array(by_dim[dim])[near], far[np.arange(len(own)), near]
                for (i, _), row, c, d in zip(own, data, cells.tolist(), dist.tolist()):
                    out.append((c, d, i, *_pack(row)[:1], dim, _pack(row)[1]))
            kinds = [pa.int32(), pa.float64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 6, kinds)], names=["cell", "dist", "id", "width", "dim", "vec"])

    placed = cut(valid.select("id", "vec").mapInArrow(assign, ROW))
    near = Window.partitionBy("cell").orderBy("dist", "id")
    few = placed.select("cell", "dist", "id").withColumn("n", F.row_number().over(near)).where(F.col("n") <= k + 1)
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.max("dist").alias("radius"))
    summary = {r["cell"]: (r["size"], r["radius"], sorted(r["least"])) for r in sizes.join(few.groupBy("cell").agg(F.collect_list("dist").alias("least")), "cell").collect()}
    salts = {c: -(-s // SALT) for c, (s, _, _) in summary.items()}

    def wanted(q: np.ndarray, dim: int) -> list[int]:
        """Cells that may hold one of the k best of a query, itself not counted."""
        own = [c for c in (*by_dim.get(dim, ()), -dim - 1) if c in summary]
        length, sure, top = float(np.sqrt(q @ q)), [], {}
        for c in own:
            size, radius, least = summary[c]
            if c < 0:
                top[c] = math.inf
                continue
            at = float(q @ chosen[c])
            slack = 1e-9 * (abs(at) + length * (radius + 1)) + 1e-6
            top[c] = at + length * radius + slack
            sure += [at - length * d - slack for d in least]
        sure.sort(reverse=True)
        floor = sure[k] if len(sure) > k else -math.inf  # the (k+1)-th, for one may be the query itself
        return [c for c in own if top[c] >= floor]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of queries of a cell, one row for each cell and salt that one of them wants."""
        def flush(cell, dim, width, block):
            data = np.stack([_unpack(v, width, dim)[0] if dim else np.zeros(0) for _, v in block])
            cells = sorted({c for q in data for c in wanted(q, dim)})
            rows = [(c, s) for c in cells for s in range(salts[c])]
            ids = np.array([i for i, _ in block], dtype="<i8").tobytes()
            n = len(rows)
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int32()), pa.array([s for _, s in rows], pa.int32()), pa.array([dim] * n, pa.int32()), pa.array([width] * n, pa.int32()), pa.array([ids] * n, pa.binary()), pa.array([b"".join(v for _, v in block)] * n, pa.binary())], names=["cell", "salt", "q_dim", "q_width", "q_ids", "q_vecs"])

        yield from (flush(*b) for b in _blocks(batches, QUERY_BLOCK, ("cell", "dim", "width")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, salt, dim, width, block in _blocks(batches, BLOCK, ("cell", "salt", "dim", "width")):
            ids = np.array([i for i, _ in block], dtype="<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([salt], pa.int32()), pa.array([width], pa.int32()), pa.array([ids], pa.binary()), pa.array([b"".join(v for _, v in block)], pa.binary())], names=["cell", "salt", "width", "ids", "vecs"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def hand_on():
            q = np.repeat(np.array(list(held), dtype=np.int64), [len(s) for s, _ in held.values()])
            s, i = (np.concatenate([x[j] for x in held.values()]) if held else np.empty(0, dtype=np.int64) for j in (0, 1))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s)], names=["query_id", "id", "score"])

        for batch in batches:
            for r in batch.to_pylist():
                asking, ids = np.frombuffer(r["q_ids"], dtype="<i8"), np.frombuffer(r["ids"], dtype="<i8")
                scores = products(_unpack(r["q_vecs"], r["q_width"], r["q_dim"]) if r["q_dim"] else np.zeros((len(asking), 0)), _unpack(r["vecs"], r["width"], r["q_dim"]) if r["q_dim"] else np.zeros((len(ids), 0)))
                for q, row in zip(asking.tolist(), scores):
                    other = ids != q
                    s, i = row[other], ids[other]
                    at = best(s, i, k)
                    s, i = s[at], i[at]
                    if q in held:
                        s, i = np.concatenate([held[q][0], s]), np.concatenate([held[q][1], i])
                        at = best(s, i, k)
                        s, i = s[at], i[at]
                    held[q] = s, i
                if len(held) >= HELD:
                    yield hand_on()
        yield hand_on()

    few_salts = F.broadcast(spark.createDataFrame(list(salts.items()) or [(0, 1)], "cell int, salts int"))  # a row a pivot
    salted = placed.join(few_salts, "cell").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = salted.repartition(parts, "cell", "salt").sortWithinPartitions("cell", "salt", "dim", "width", "id").select("cell", "salt", "dim", "width", "id", "vec").mapInArrow(pack, "cell int, salt int, width int, ids binary, vecs binary")
    asks = placed.join(valid.where("asks").select("id"), "id", "left_semi")
    sent = asks.repartition(parts, "cell", F.pmod(F.xxhash64("id"), F.lit(16))).sortWithinPartitions("cell", "dim", "width", "id").select("cell", "dim", "width", "id", "vec").mapInArrow(send, "cell int, salt int, q_dim int, q_width int, q_ids binary, q_vecs binary")
    found = sent.hint("shuffle_hash").join(data, ["cell", "salt"]).select("q_dim", "q_width", "q_ids", "q_vecs", "width", "ids", "vecs").mapInArrow(search, "query_id long, id long, score long")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")


def _blocks(batches: Iterator[pa.RecordBatch], size: int, names: tuple[str, ...]) -> Iterator[tuple]:
    """Runs of rows with equal ``names``, at most ``size`` long: the names' values and (id, vec) pairs."""
    now, block = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        for *head, i, v in zip(*columns, batch.column("id").to_pylist(), batch.column("vec").to_pylist()):
            if block and (head != now or len(block) == size):
                yield (*now, block)
                block = []
            now = head
            block.append((i, v))
    if block:
        yield (*now, block)
