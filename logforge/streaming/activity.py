"""Keyed state with timers: bursts of a key's lines that close by themselves once the key has been quiet."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

WATERMARK = "10 minutes"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
Run = tuple[int, int, int]


def merged(runs: list[Run], gap_us: int) -> list[Run]:
    """Runs (first, last, lines) in order, joined where no more than the gap lies between."""
    out: list[Run] = []
    for first, last, n in sorted(runs):
        if out and first - out[-1][1] <= gap_us:
            out[-1] = (out[-1][0], max(last, out[-1][1]), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


class Bursts(StatefulProcessor):
    """The open runs of a key; a timer closes a run when nothing that may still come could lengthen it, so no state stays."""

    def __init__(self, keys: list[str], gap_us: int):
        self.keys, self.gap_us = keys, gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getListState("runs", "first_us long, last_us long, n_lines long")

    def _held(self) -> list[Run]:
        return [tuple(r) for r in self.runs.get()] if self.runs.exists() else []

    def _keep(self, runs: list[Run]) -> None:
        if not runs:
            self.runs.clear()
            return
        self.runs.put(runs)
        # One timer a key, for the run that ends first; a microsecond past the gap, in whole milliseconds.
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer((runs[0][1] + self.gap_us) // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        runs = self._held()
        for pdf in rows:
            runs = merged(runs + list(zip(pdf["first_us"].tolist(), pdf["last_us"].tolist(), pdf["n_lines"].tolist(), strict=True)), self.gap_us)
        self._keep(runs)
        yield self._frame(key, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        runs = self._held()
        done = [r for r in runs if r[1] + self.gap_us < now]
        self._keep([r for r in runs if r[1] + self.gap_us >= now])
        yield self._frame(key, done)

    def _frame(self, key, runs: list[Run]) -> pd.DataFrame:
        columns = {name: pd.Series([value] * len(runs), dtype=object) for name, value in zip(self.keys, key, strict=True)}
        for i, name in enumerate(("first_us", "last_us", "n_lines")):
            columns[name] = pd.Series([r[i] for r in runs], dtype="int64")
        return pd.DataFrame(columns)


def _seconds(keys: list[str], us: str):
    """Lines of one key and second as one row, batch by batch: a hot key sends few rows to its state."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            some = table.group_by([*keys, "_s"]).aggregate([(us, "min"), (us, "max"), (us, "count")])
            table = some.select([*keys, f"{us}_min", f"{us}_max", f"{us}_count"]).rename_columns([*keys, "first_us", "last_us", "n_lines"])
            yield from table.combine_chunks().to_batches()

    return merge


def activity_stream(lines: DataFrame, keys: list[str], gap_s: int, watermark: str = WATERMARK, us: str = "us") -> DataFrame:
    """Bursts (keys, first_us, last_us, n_lines) of a stream of lines, each emitted once its key has been quiet for ``gap_s``.

    ``keys`` are texts.  Lines may come out of order within the watermark.  What
    is open at the end of a run lies in its state: see ``open_activity``.
    Start the stream within ``timed_state``.
    """
    if gap_s < 1:
        raise ValueError("a gap of at least one second")
    named = ", ".join(f"`{k}` string" for k in keys)
    counts = "first_us long, last_us long, n_lines long"
    known = lines.filter(F.col(us).isNotNull()).select(*keys, us, F.floor(F.col(us) / 1_000_000).alias("_s"))
    merged_lines = known.mapInArrow(_seconds(keys, us), f"{named}, {counts}")
    timed = merged_lines.withColumn("ts", F.timestamp_micros("last_us")).withWatermark("ts", watermark)
    return timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=Bursts(list(keys), gap_s * 1_000_000),
        outputStructType=f"{named}, {counts}",
        outputMode="append",
        timeMode="eventTime",
    )


def open_activity(spark: SparkSession, checkpoint: str, keys: list[str]) -> DataFrame:
    """Bursts that a run has left open, read from its state: the closing step."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "runs").load()
    return state.select(*[F.col("key").getField(k).alias(k) for k in keys], "list_element.*")


@contextmanager
def timed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in the store that timers need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
