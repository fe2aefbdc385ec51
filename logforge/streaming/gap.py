"""Sent against received as a stream: what has not arrived within a bound."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"
COLUMNS = ("host", "ts", "digest", "sent", "received", "missing")


@contextmanager
def newest_mark(spark: SparkSession) -> Iterator[None]:
    """Streams started within go by the source that is furthest on.

    By the slowest one, a receiver that gets nothing would hold back every gap.
    """
    before = spark.conf.get(_POLICY, None)
    spark.conf.set(_POLICY, "max")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_POLICY)
        else:
            spark.conf.set(_POLICY, before)


def _counted(lines: DataFrame, name: str, bound: str, line: str | Column) -> DataFrame:
    """Copies of a line with one stamp as one row, so the join is one to one."""
    digest = F.sha2(F.col(line) if isinstance(line, str) else line, 256)
    keyed = lines.select(F.coalesce("host", F.lit("")).alias(f"{name}_host"), F.coalesce(digest, F.lit("")).alias(f"{name}_digest"), F.col("ts").alias(f"{name}_ts"))
    known = keyed.filter(F.col(f"{name}_ts").isNotNull()).withWatermark(f"{name}_ts", bound)
    return known.groupBy(f"{name}_host", f"{name}_digest", f"{name}_ts").agg(F.count(F.lit(1)).alias(name))


def _short(joined: DataFrame) -> DataFrame:
    received = F.coalesce("received", F.lit(0).cast("bigint"))
    rows = joined.select(
        F.col("sent_host").alias("host"), F.col("sent_ts").alias("ts"), F.col("sent_digest").alias("digest"),
        "sent", received.alias("received"), (F.col("sent") - received).alias("missing"),
    )
    return rows.filter("missing > 0")


def _matches(s: DataFrame, r: DataFrame) -> DataFrame:
    on = [s[f"sent_{c}"] == r[f"received_{c}"] for c in ("host", "digest", "ts")]
    return s.join(r, on, "left_outer")


def gap_stream(sent: DataFrame, received: DataFrame, bound: str = "10 minutes", line: str = "msg") -> DataFrame:
    """Lines (host, ts, digest) sent more often than received, each emitted once the newest stamp is ``bound`` past it.

    Both streams have ``host``, ``ts`` (the stamp that the line carries at both
    ends) and the text.  A copy that arrives within the bound leaves the gap,
    whichever side comes first; one that comes after its gap was told changes
    nothing.  A missing host or text counts as an empty one; lines without a stamp
    cannot be followed and are left out (see ``undated``), as are sent lines that
    come when the mark has passed them.
    Start the stream within ``newest_mark``.
    """
    return _short(_matches(_counted(sent, "sent", bound, line), _counted(received, "received", bound, line)))


def open_gap(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The closing step of a run: the gap among the lines that its state still holds.

    Lines lie in the counts of their side until the mark has passed them, then
    in the join, which waits for the other side.
    """
    kept = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorName").distinct()
    state = lambda op, **more: spark.read.format("statestore").options(operatorId=op, **more).load(checkpoint)
    sides: dict[str, list[DataFrame]] = {"sent": [], "received": []}
    for op, name in kept.collect():  # three operators
        if name == "symmetricHashJoin":
            for side, where in (("sent", "left"), ("received", "right")):
                sides[side].append(state(op, joinSide=where).select("value.*"))
        else:
            counts = state(op)
            side = counts.select("key.*").columns[0].split("_")[0]
            sides[side].append(counts.select("key.*", F.col("value.count").alias(side)))
    held = []
    for side, parts in sides.items():
        columns = [f"{side}_host", f"{side}_digest", f"{side}_ts", side]
        rows = parts[0].select(*columns)
        for more in parts[1:]:
            rows = rows.unionByName(more.select(*columns))
        held.append(rows)
    return _short(_matches(*held))


def closed_gap(emitted: DataFrame, left: DataFrame) -> DataFrame:
    """All gaps of a closed run.  A pair that the join has emitted and still holds is one row."""
    return emitted.select(*COLUMNS).unionByName(left.select(*COLUMNS)).distinct()
