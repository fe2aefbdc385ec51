"""Streaming runs: sinks that survive a replay, and stateful operators.

Stateless operators need nothing from here: a streaming frame goes through
them like a batch frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logforge.functions.audit import is_execve
from logforge.operators.enrich import enrich_execve
from logforge.operators.events import event_aggregates, event_columns
from logforge.operators.reduce import extend_repeats, rate_cap, reduce_repeats
from logforge.operators.routing import forwarded

WATERMARK = "10 minutes"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch to its own folder; a replay overwrites it."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def each_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Start ``handle(batch, batch_id)`` over all data available now."""
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet files exactly once, over all data available now."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_stream(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    profile: str = "debian",
    mode: str = "compat",
    passwd: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> StreamingQuery:
    """Forward raw lines and the enriched EXECVE copy from one pass.

    ``lines`` are parsed syslog rows.  Each micro-batch is kept while both
    outputs are written: ``out/raw`` and ``out/enriched``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = forwarded(batch, profile).persist()
        try:
            write_batch(kept, f"{out}/raw", batch_id)
            copy = kept.filter(is_execve("msg"))
            write_batch(
                enrich_execve(copy, "msg", mode, profile, passwd, groups),
                f"{out}/enriched",
                batch_id,
            )
        finally:
            kept.unpersist()

    return each_batch(lines, handle, checkpoint)


def windowed_counts(
    lines: DataFrame, width: str = "1 minute", keys=("host",), watermark: str = WATERMARK
) -> DataFrame:
    """Lines per closed time window and key; late lines are counted until the watermark."""
    return (
        lines.withWatermark("ts", watermark)
        .groupBy(F.window("ts", width).alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


def assemble_stream(
    records: DataFrame, watermark: str = WATERMARK, line: str = "msg", mode: str = "compat"
) -> DataFrame:
    """Events of a record stream, each emitted once the watermark has passed it."""
    grouped = (
        records.filter(F.col("epoch_ms").isNotNull())
        .withColumn("event_ts", F.timestamp_millis("epoch_ms"))
        .withWatermark("event_ts", watermark)
        .groupBy("serial", "event_ts", "host")
        .agg(*event_aggregates(line, mode))
    )
    return event_columns(grouped).withColumn("epoch_ms", F.unix_millis("event_ts"))


def dedup_stream(
    records: DataFrame, prefer: str = "program", watermark: str = WATERMARK, line: str = "msg"
) -> DataFrame:
    """Audit records once each, emitted when the watermark has passed them.

    An aggregation and not ``dropDuplicatesWithinWatermark``: copies merge
    before the shuffle, so a record repeated without end stays one row per
    task.  Lines without an audit header are no records and pass at once.
    """
    keys = ["serial", "event_ts", "host", "record_type", line]
    rest = [prefer] + [c for c in records.columns if c not in keys + [prefer, "epoch_ms"]]
    once = (
        records.filter(F.col("epoch_ms").isNotNull())
        .withColumn("event_ts", F.timestamp_millis("epoch_ms"))
        .withWatermark("event_ts", watermark)
        .groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_first"))
        .select(*keys, "_first.*")
        .withColumn("epoch_ms", F.unix_millis("event_ts"))
    )
    headerless = records.filter(F.col("epoch_ms").isNull()).withColumn("event_ts", F.lit(None).cast("timestamp"))
    return once.unionByName(headerless.select(*once.columns))


def repeats_stream(
    lines: DataFrame,
    keys: list[str],
    order: list[str],
    out: str,
    checkpoint: str,
    message: str = "msg",
) -> StreamingQuery:
    """Collapse repeated messages of a stream; runs continue across micro-batches.

    The last run of every key stays open.  Open runs (one row per key) are
    kept under ``out/open``, one folder per batch, so that a replayed batch
    starts from the same state; finished runs go to ``out/closed``.  All heavy
    steps are those of the batch operator, so a hot key is split over tasks.
    A late line sorts before the open run and is passed on as a run of its own.
    """
    last = [f"last_{c}" for c in order]

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            runs = reduce_repeats(batch, keys, order, message)
        else:
            carried = spark.read.parquet(f"{out}/open/batch_id={batch_id - 1}")
            runs = extend_repeats(carried, batch, keys, order, message)
        # Written once and read back: both outputs then see the same runs.
        write_batch(runs, f"{out}/runs", batch_id)
        runs = spark.read.parquet(f"{out}/runs/batch_id={batch_id}")
        newest = (
            runs.groupBy(*keys).agg(F.max(F.struct(*last)).alias("_m")).select(*keys, "_m.*")
        )
        on = [runs[c].eqNullSafe(newest[c]) for c in [*keys, *last]]
        write_batch(runs.join(newest, on, "left_semi"), f"{out}/open", batch_id)
        write_batch(runs.join(newest, on, "left_anti"), f"{out}/closed", batch_id)

    return each_batch(lines, handle, checkpoint)


def repeats_so_far(spark: SparkSession, out: str) -> DataFrame:
    """Finished runs and the open ones of the newest batch."""
    opened = spark.read.parquet(f"{out}/open")
    newest = opened.agg(F.max("batch_id")).first()[0]  # one number
    current = opened.filter(F.col("batch_id") == newest)
    return spark.read.parquet(f"{out}/closed").unionByName(current).drop("batch_id")


def rate_cap_stream(
    lines: DataFrame,
    keys: list[str],
    order: list[str],
    per_group: int,
    out: str,
    checkpoint: str,
    expire: str | None = None,
    horizon: int = 3600,
) -> StreamingQuery:
    """Keep the first ``per_group`` lines per key over all micro-batches.

    Counts so far live under ``out/counts``, one folder per batch.  ``expire``
    names a numeric key (seconds): counts more than ``horizon`` older than the
    newest key are forgotten, as a watermark would.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if per_group <= 0:  # no cap: every line passes, and nothing is counted
            write_batch(batch, f"{out}/kept", batch_id)
            return
        # More than the cap can never be kept, so the batch is cut first.
        capped = rate_cap(batch, keys, order, per_group, rank="_rank")
        if batch_id == 0:
            kept = capped.filter(F.col("_rank") <= per_group).drop("_rank")
            before = None
        else:
            before = spark.read.parquet(f"{out}/counts/batch_id={batch_id - 1}")
            kept = (
                capped.join(before, keys, "left")
                .filter(F.col("_rank") + F.coalesce("n_kept", F.lit(0)) <= per_group)
                .drop("_rank", "n_kept")
            )
        write_batch(kept, f"{out}/kept", batch_id)
        kept = spark.read.parquet(f"{out}/kept/batch_id={batch_id}")
        counts = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_kept"))
        if before is not None:
            counts = (
                counts.unionByName(before).groupBy(*keys).agg(F.sum("n_kept").alias("n_kept"))
            )
        if expire:
            newest = counts.agg(F.max(expire)).first()[0]
            if newest is not None:
                counts = counts.filter(F.col(expire) >= newest - horizon)
        write_batch(counts, f"{out}/counts", batch_id)

    return each_batch(lines, handle, checkpoint)
