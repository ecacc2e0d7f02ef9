"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import contextvars
import gc
import sys
import tempfile
import time
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Setting that drops the shuffle files of an action at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: log2 of the bits of a filter, at least and at most (rows of 64 bits are broadcast: 2 to 16 MB).
FILTER_BITS = 23
MOST_FILTER_BITS = 26
#: Share of the time that ``relieve`` may take within ``lean``.
RELIEF = 0.03
#: Partitions of a packed frame in blocks, for each that files of its size would be read in at least.
BLOCKS = 4
#: What Spark says when a block of a frame is gone.
LOST = "CHECKPOINT_RDD_BLOCK_ID_NOT_FOUND"
_cuts: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("cuts", default=None)
_safe: contextvars.ContextVar[bool] = contextvars.ContextVar("safe", default=False)
_lean: contextvars.ContextVar[list[float] | None] = contextvars.ContextVar("lean", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir`` of the session.

    A session without one gets a temporary folder if it runs in one process (tests); on a cluster that
    is an error, as executors could not read it.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="shared-")


def _trim(spark: SparkSession) -> bool:
    """Has the driver's JVM return the free pages of its native heap; whether it can (HotSpot on Linux)."""
    jvm = spark._jvm
    name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    # by reflection, as the class of the server is not exported
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    given = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    given[0], given[1] = name, "systemTrimNativeHeap"
    try:
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        return False
    return True


def relieve(spark: SparkSession) -> None:
    """Has the driver's JVM give back what it holds but doesn't use.

    Garbage, and broadcasts and plans that only garbage keeps, stay until the heap is at its limit, and free
    native memory for good; after hundreds of small stages both add up.
    """
    gc.collect()
    spark._jvm.System.gc()
    _trim(spark)


@contextlib.contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Within, ``cut`` relieves the driver's JVM now and then, and so do begin and end."""
    relieve(spark)
    token = _lean.set([0.0])
    try:
        yield
    finally:
        _lean.reset(token)
        relieve(spark)


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Frames made within drop the shuffle files of an action when it ends; for those that run one action only."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, packed: bool = False) -> DataFrame:
    """``df`` as it is now, without its lineage and its shuffle files.

    Within ``settled`` it stays in blocks on the executors' disks (two copies), else it is written to the folder that the
    executors share. ``packed`` is for large frames: how rows were dealt out is forgotten, files are Parquet.
    What was written goes with ``drop`` or at the end of ``settled``, else when the driver collects its garbage
    (packed files: when it ends).
    """
    spark = df.sparkSession
    within = _cuts.get()
    out = _written(df, packed) if within is None or _safe.get() else _held(df, packed)
    if within is not None:
        within.append(out)
    if (due := _lean.get()) is not None and (began := time.monotonic()) >= due[0]:
        relieve(spark)
        due[0] = time.monotonic() + (time.monotonic() - began) / RELIEF
    return out


def _written(df: DataFrame, packed: bool) -> DataFrame:
    """``df`` in files of the shared folder, which the loss of an executor doesn't harm."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))
    with tidy(spark):
        once = df.select("*")
        if packed:
            path = f"{context._jsc.sc().getCheckpointDir().get()}/cut-{uuid.uuid4().hex}"
            once.write.parquet(path, compression="snappy")
            out = spark.read.schema(df.schema).parquet(path)
            place, files = _place(spark, path)
            files.deleteOnExit(place)
    if not packed:
        out = once.checkpoint()
        path = out._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
    out._cut = path
    return out


def _held(df: DataFrame, packed: bool) -> DataFrame:
    """``df`` in blocks on the executors' disks, each on two executors so that the loss of one does no harm.

    On a local or mounted file system Hadoop starts two processes (``chmod``) for every file that it writes,
    and each counts as large as the executor's JVM until it runs its program; blocks need none.
    """
    spark = df.sparkSession
    with tidy(spark):
        once = df.select("*")
    out = once.localCheckpoint(storageLevel=StorageLevel.DISK_ONLY_2)
    rdd = out._jdf.queryExecution().logical().rdd()
    if packed:  # about as many partitions as files of that size would be read in
        stored = sum(x.diskSize() for x in spark.sparkContext._jsc.sc().getRDDStorageInfo() if x.id() == rdd.id())
        most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        out = out.coalesce(max(spark.sparkContext.defaultParallelism, -(-BLOCKS * stored // most)))
    out._cut = rdd
    return out


def _place(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """A path and its file system, of the JVM."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop(*frames: DataFrame) -> None:
    """Deletes the files or blocks of frames that ``cut`` made; they and what reads them can't be used any more."""
    within = _cuts.get() or []
    for df in frames:
        if isinstance(df._cut, str):
            place, files = _place(df.sparkSession, df._cut)
            files.delete(place, True)
            files.cancelDeleteOnExit(place)
        else:
            df._cut.unpersist(False)
        if df in within:
            within.remove(df)


def settled(build: Callable[[], DataFrame], packed: bool = False) -> DataFrame:
    """What ``build`` makes, cut; what all frames that it has cut on the way have written is deleted.

    If blocks are lost with an executor, ``build`` runs once more and writes files.
    """
    try:
        return _settled(build, packed)
    except Exception as failed:
        if _safe.get() or LOST not in str(failed):
            raise
    token = _safe.set(True)
    try:
        return _settled(build, packed)
    finally:
        _safe.reset(token)


def _settled(build: Callable[[], DataFrame], packed: bool) -> DataFrame:
    inner: list[DataFrame] = []
    token = _cuts.set(inner)
    try:
        try:
            made = build()
        finally:
            _cuts.reset(token)
        return cut(made, packed)
    finally:
        drop(*inner)


def first(df: DataFrame) -> Row | None:
    """The first row of ``df``; the shuffle files of finding it are dropped."""
    with tidy(df.sparkSession):
        once = df.select("*")
    return once.first()


def size(df: DataFrame) -> int:
    """How many rows ``df`` has; the shuffle files of counting are dropped."""
    return first(df.groupBy().count())[0]


def maybe(found: DataFrame, wanted: DataFrame, key: str, n: int) -> DataFrame:
    """``found`` without most of the rows whose ``key``, a hash, isn't among the ``n`` or fewer wanted; none of those is lost.

    The bits of a filter go to all tasks, so that other rows drop out before any shuffle; a join has to follow.
    """
    bits = min(max(FILTER_BITS, (32 * n).bit_length()), MOST_FILTER_BITS)
    word, bit = F.shiftright(F.col(key), 6).bitwiseAND((1 << (bits - 6)) - 1).cast("int"), F.col(key).bitwiseAND(63).cast("int")
    marks = wanted.groupBy(word.alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({key} & 63 as int))")).alias("bits"))
    return found.withColumns({"word": word, "bit": bit}).join(F.broadcast(marks), "word").where("(shiftright(bits, bit) & 1) = 1").drop("word", "bit", "bits")


def pieces(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``max_bytes`` of ``column`` each; a longer value stands alone."""
    if not batch.num_rows:
        return
    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths.astype(np.int64)) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        yield batch.slice(begin, end - begin)


def kept(name: tuple, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, kept under ``name`` in this worker process for its next tasks."""
    store = sys.modules.setdefault("_tallyline_kept", types.ModuleType("_tallyline_kept")).__dict__
    if name not in store:
        store[name] = build()
    return store[name]
