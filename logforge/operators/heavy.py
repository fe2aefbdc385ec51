"""Heavy hitters by mergeable summaries of fixed size, and counts that can be added up later."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.scale import fits, work_dir

CAPACITY = 4096


def _summaries(capacity: int):
    """A task's counters: with more than ``capacity`` keys, the next largest count is taken off all."""

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str | None, int] = {}
        lost = 0
        for batch in batches:
            for entry in pc.value_counts(batch.column(0)).to_pylist():
                key = entry["values"]
                counts[key] = counts.get(key, 0) + entry["counts"]
            if len(counts) > capacity:
                cut = sorted(counts.values(), reverse=True)[capacity]
                counts = {k: n - cut for k, n in counts.items() if n > cut}
                lost += cut
        # One row without a key tells what was taken off: no key lacks more than that.
        yield pa.RecordBatch.from_arrays(
            [pa.array([*counts, None], pa.string()), pa.array([*counts.values(), 0], pa.int64()), pa.array([0] * len(counts) + [lost], pa.int64()), pa.array([True] * len(counts) + [False])],
            names=["key", "n", "lost", "counted"],
        )

    return summarize


def heavy_hitters(df: DataFrame, key: Column | str, k: int = 10, capacity: int = CAPACITY) -> DataFrame:
    """(key, n): the ``k`` keys with the most rows, exactly; ties to the smaller key, NULL first.

    Each task keeps ``capacity`` counters, whatever the number of distinct keys,
    and knows how much a key can lack.  Summaries add up; keys that can be among
    the ``k`` are then counted in one more pass.  Where no key stands out, the
    summaries cannot decide and all keys are counted.
    """
    if not 1 <= k <= capacity:
        raise ValueError("k must be from 1 to the capacity")
    keys = df.select((F.col(key) if isinstance(key, str) else key).cast("string").alias("key"))
    parts = keys.mapInArrow(_summaries(capacity), "key string, n long, lost long, counted boolean")
    # Flags keep the NULL key apart from the rows that tell losses.
    sums = parts.groupBy("key", "counted").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost"))
    # Small whatever the input; written, as it is used three times.
    path = work_dir(df.sparkSession, "summaries")
    sums.write.parquet(path)
    sums = df.sparkSession.read.schema(sums.schema).parquet(path)
    order = [F.col("n").desc(), F.col("key").asc_nulls_first()]
    top = sums.orderBy(F.col("counted").desc(), *order).limit(k).collect()
    lost = sums.agg(F.sum("lost")).first()[0] or 0
    least = min((r.n for r in top if r.counted), default=0) if sum(r.counted for r in top) == k else 0
    if lost == 0:
        return sums.filter("counted").select("key", "n").orderBy(*order).limit(k)
    if least <= lost:  # a key without a counter may have as many rows
        return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).orderBy(*order).limit(k)
    able = sums.filter(F.col("counted") & (F.col("n") + lost >= least)).select("key")
    able = F.broadcast(able) if fits(able) else able
    exact = keys.join(able, keys["key"].eqNullSafe(able["key"]), "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return exact.orderBy(*order).limit(k)


# Of 2**12 registers: a standard error of 1.04 / 64, some 1.6 percent.
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, keys: list[str], value: str, bits: int = SKETCH_BITS) -> DataFrame:
    """(keys, sketch): a mergeable sketch of the distinct values of each group, to be stored; groups without a value have none."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, bits).alias("sketch"))


def add_up(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): distinct values over all sketches of a group, such as users over days.  Nobody is counted twice."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))
