"""Helpers shared by the operators: lineage cuts, document keys, Arrow buffers.

Document identity.  ``keyed`` narrows any table to ``doc_id, th, text`` where
``th`` is the 64-bit hash of the text, so extra or clashing columns never get in.
Rows that repeat id and text are separate documents with equal results; rows
that share an id but differ in text are told apart by ``th``.  A null id is a
key of its own (joins are null-safe); a null text counts as empty.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words everywhere here: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def tidy(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A mapInArrow function that hands its freed memory back when a task ends; workers are reused."""

    @functools.wraps(f)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from f(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return run


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let_go(spark: SparkSession) -> None:
    """Free what nothing refers to any more, in Python and then in the JVM; shuffle files go with it.

    py4j tells the JVM of what Python has dropped from a thread that looks each second, too late
    for a collection right behind; so what waits for that thread is told here.
    """
    gc.collect()
    waiting = getattr(getattr(spark.sparkContext._gateway, "_gateway_client", None), "finalizer_deque", None)
    while waiting:
        try:
            task = waiting.pop()
        except IndexError:  # that thread was faster
            break
        if not isinstance(task, tuple):  # its sign to end
            waiting.append(task)
            break
        task[0].garbage_collect_object(task[1], False)
    spark.sparkContext._jvm.System.gc()  # now, not when the driver happens to collect


def settle(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the cluster's shared folder and let go of the shuffles behind it.

    The folder is spark.checkpoint.dir; only where that is unset and the master
    is local (tests, a laptop) a temporary one is made.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))
    out = df.checkpoint(eager=True)
    del df  # the last reference to the plan that made them, so its shuffle files go
    out.isEmpty()  # Spark itself holds the plan of the last execution: let that be another
    let_go(out.sparkSession)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def join_keyed(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on (doc_id, th), null ids equal; the right side's key columns are dropped."""
    r = right.withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    return left.join(r, left.doc_id.eqNullSafe(r._id) & (left.th == r._th), how).drop("_id", "_th")


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its n+1 offsets (from 0)."""
    a = pc.cast(pc.fill_null(col, "") if not pa.types.is_binary(col.type) else pc.fill_null(col, b""), pa.large_binary())
    off = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1, a.offset * 8) if len(a) else np.zeros(1, np.int64)
    if not len(a) or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(a) + 1, np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def pieces(off: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges [a, b) of about ``limit`` bytes; a longer row is a range of its own."""
    out, a, n = [], 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        out.append((a, min(b, n)))
        a = out[-1][1]
    return out


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def string_list(col) -> list[str]:
    """Texts of a column, null as empty; unpaired surrogates cannot occur in Spark's UTF-8."""
    return [x or "" for x in col.to_pylist()]
