"""Registered streaming jobs over lines derived from ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logforge.operators.events import EVENT_KEY, assemble_events, dedup_sources
from logforge.operators.routing import forwarded
from logforge.plans.fleet import accounts, derive_lines, fleet_lines
from logforge.plans.flow import process_lines
from logforge.scale import work_dir
from logforge.sources.logs import parse_audit
from logforge.streaming.activity import activity_stream, open_activity, timed_state
from logforge.streaming.carry import DELAY_MS, Operator, carry_stream, close_stream, late_rows
from logforge.streaming.gap import closed_gap, gap_stream, newest_mark, open_gap
from logforge.streaming.run import (
    append_files,
    repeats_so_far,
    repeats_stream,
    windowed_counts,
)


def stream_lines(spark: SparkSession, sf: str, text: bool = True) -> DataFrame:
    path = f"{sf}/events.parquet"
    schema = spark.read.parquet(path).schema
    # A file stream takes folders and patterns: the braces make one of a single file.
    return derive_lines(spark.readStream.schema(schema).parquet(f"{sf}/{{events.parquet}}"), text)


def _finished(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run a streaming frame over everything available and read its output."""
    base = work_dir(spark, name)
    append_files(df, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def stream_route_enrich(spark: SparkSession, sf: str) -> DataFrame:
    passwd, groups = accounts(fleet_lines(spark, sf, text=False))
    lines = stream_lines(spark, sf).select("event_id", "line")
    out = process_lines(lines, "line", passwd=passwd, groups=groups)
    return _finished(
        spark, out.select("event_id", "route", "cmd", "mitre_techniques", "line_out"), "route"
    )


def stream_eps(spark: SparkSession, sf: str) -> DataFrame:
    lines = stream_lines(spark, sf, text=False).select("host", F.timestamp_micros("us").alias("ts"))
    counts = windowed_counts(lines, "5 minutes")
    return _finished(
        spark,
        counts.select(F.unix_micros("window.start").alias("start_us"), "host", "n_lines"),
        "eps",
    )


# Files of a delivery, more if they would hold more than FILE_ROWS; a micro-batch takes one delivery.
_FILES = 8
FILE_ROWS = 50_000


def delivered(spark: SparkSession, sf: str, turns: int = 4, held_back: Column | None = None) -> DataFrame:
    """The lines as a stream of several micro-batches: events are written in ``turns``, one after the other.

    Rows of ``held_back`` come in the last turn whatever their time.
    """
    events = spark.read.parquet(f"{sf}/events.parquet")
    low, high, n = events.agg(F.min("event_id"), F.max("event_id"), F.count(F.lit(1))).first()  # three numbers
    files = max(_FILES, n // turns // FILE_ROWS)
    base = work_dir(spark, "deliveries")
    width = max(1, ((high or 0) - (low or 0) + turns) // turns)
    turn = F.least(((F.col("event_id") - F.lit(low or 0)) / width).cast("int"), F.lit(turns - 1))
    if held_back is not None:
        turn = F.when(held_back, F.lit(turns - 1)).otherwise(turn)
    for k in range(turns):
        rows = events.filter(turn == k)
        # Many files are dealt in turn, so that repeated ids leave none of them empty.
        rows = rows.repartition(_FILES, "event_id") if files == _FILES else rows.repartition(files)
        rows.write.parquet(f"{base}/{k}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files)
    return derive_lines(stream.parquet(f"{base}/*"))


def _carried(spark: SparkSession, rows: DataFrame, finish: Operator, name: str, delay_ms: int = DELAY_MS) -> tuple[DataFrame, DataFrame]:
    """Finished and late rows of a closed run."""
    base = work_dir(spark, name)
    carry_stream(rows, finish, f"{base}/out", f"{base}/checkpoint", delay_ms).awaitTermination()
    return close_stream(spark, finish, f"{base}/out"), late_rows(spark, f"{base}/out")


def stream_assembly(spark: SparkSession, sf: str) -> DataFrame:
    records = parse_audit(delivered(spark, sf)).select(*EVENT_KEY, "record_type", "msg")
    events, _ = _carried(spark, records, assemble_events, "assembly")
    return events.select("host", "epoch_ms", "serial", "n_records", "cmd", "path", "auid_id", "key", "failed")


def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Early lines that come with the last delivery: each is in the side output, none in an event."""
    late = (F.col("event_id") % 97 == 0) & (F.col("event_id") < F.lit(400))
    records = parse_audit(delivered(spark, sf, held_back=late)).select("event_id", *EVENT_KEY, "record_type", "msg")
    events, late = _carried(spark, records, assemble_events, "late", 1000)
    counted = events.agg(F.sum("n_records").alias("n")).select(F.lit("assembled").alias("output"), "n")
    side = late.groupBy(F.concat(F.lit("late "), F.col("event_id").cast("string")).alias("output")).agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(side)


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every line once, where audit lines come from two sources."""
    lines = parse_audit(delivered(spark, sf)).withColumn("_copies", F.when(F.col("program") == "audit", F.array(F.lit("audit"), F.lit("audit-direct"))).otherwise(F.array("program")))
    both = lines.withColumn("program", F.explode("_copies")).drop("_copies")
    once, _ = _carried(spark, both, dedup_sources, "dedup")
    return once.select("event_id", "program", F.md5("msg").alias("msg_md5"))


def stream_repeat(spark: SparkSession, sf: str) -> DataFrame:
    base = work_dir(spark, "repeat")
    lines = delivered(spark, sf).select("host", "program", "us", "event_id", "msg")
    query = repeats_stream(
        lines, ["host", "program"], ["us", "event_id"], f"{base}/runs", f"{base}/checkpoint"
    )
    query.awaitTermination()
    return repeats_so_far(spark, f"{base}/runs")


def stream_bursts(spark: SparkSession, sf: str) -> DataFrame:
    """Bursts of hosts over several micro-batches, closed by timers; those open at the end are read from the state."""
    base = work_dir(spark, "bursts")
    lines = delivered(spark, sf).select("host", "us")
    with timed_state(spark):
        df = activity_stream(lines, ["host"], 1800)
        append_files(df, f"{base}/out", f"{base}/checkpoint").awaitTermination()
        closed = spark.read.schema(df.schema).parquet(f"{base}/out")
        return closed.unionByName(open_activity(spark, f"{base}/checkpoint", ["host"]))


def stream_gap(spark: SparkSession, sf: str) -> DataFrame:
    """What the debian profile does not deliver, and early lines that arrive with the last delivery."""
    late = (F.col("event_id") % 97 == 0) & (F.col("event_id") < F.lit(400))
    base = work_dir(spark, "gap")
    sent = delivered(spark, sf).withColumn("ts", F.timestamp_micros("us"))
    received = forwarded(delivered(spark, sf, held_back=late), "debian").withColumn("ts", F.timestamp_micros("us"))
    with newest_mark(spark):
        df = gap_stream(sent, received)
        append_files(df, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    emitted = spark.read.schema(df.schema).parquet(f"{base}/out")
    gap = closed_gap(emitted, open_gap(spark, f"{base}/checkpoint"))
    return gap.select("host", F.unix_micros("ts").alias("us"), "digest", "sent", "received", "missing")
