"""Joins whose small side is checked, written steps and connected groups."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import mix

# Rows of a few numbers that may go to every executor (at most some 100 MB there); beyond, both sides are shuffled.
BROADCAST_ROWS = 2_000_000


# Rows of an Arrow batch: with texts of some kilobytes a few megabytes, in the executor and in the worker.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, after which a worker gives freed memory back: workers that wait for a next task would keep it from the others."""

    @functools.wraps(run)
    def tidied(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim is not None:
                trim(0)

    return tidied


def land(df: DataFrame, path: str) -> DataFrame:
    """Write below the shared folder and read again: later steps do not go back over lost work."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def block_id(before: int) -> int:
    """Number of the block that this task flushes after ``before`` others: another for each, whatever it holds, and the same on a retry."""
    own = np.array([TaskContext.get().partitionId() << 32 | before], np.uint64)
    return int(mix(own).view(np.int64)[0])


def checked(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` with a broadcast hint if a count shows that it is, else as it is.

    Give a table that was written: it is read to be counted.
    """
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def components(edges: DataFrame, base: str) -> DataFrame:
    """(id, component_id) of every id in ``edges`` (a, b): the smallest id reachable.

    Each round hangs all neighbours of an id on the smallest one, first the
    larger neighbours, then the smaller ones, so paths shorten by halves.  A
    round is two aggregations and two joins over the edges, and is written.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges, before = land(edges, f"{base}/edges-0"), None
    for n in range(1, 1000):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = land(large.where("a > b").distinct(), f"{base}/large-{n}")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = land(moved.union(low.select("a", F.col("m").alias("b"))).where("a > b").distinct(), f"{base}/edges-{n}")
        # A row of two numbers; equal sums of all edges mean that nothing moved.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("component_id", F.col("id"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(roots)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a session; they need not have it installed.

    Arrow batches get ``BATCH_ROWS`` rows unless the session says otherwise.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_logforge_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="logforge-")) / "logforge.zip"  # only the driver reads it; Spark serves it
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._logforge_shipped = True
