"""Log line readers and the syslog parse; batch and stream alike."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logforge.functions.audit import audit_header, header_fields, record_type
from logforge.functions.syslog import (
    HEADER,
    facility_number,
    facility_of,
    facility_text,
    header_words,
    is_short,
    long_fields,
    severity_of,
    short_fields,
    syslog_time,
)
from logforge.functions.text import capture, strip


# Severity of a tailed file's lines.
_NOTICE = 5


def _lines(spark: SparkSession, path: str, stream: bool) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def read_audit(
    spark: SparkSession, path: str, tag: str = "audit-direct", stream: bool = False, host: str | None = None
) -> DataFrame:
    """Audit log files, one record per row, stamped with tag, facility local3 and severity notice.

    The time is that of the record's header; the host is the one named by
    ``node=``, else that of ``host`` (a text, or NULL).
    """
    tailed = (
        _lines(spark, path, stream)
        .withColumn("program", F.lit(tag))
        .withColumnRenamed("value", "msg")
    )
    return with_header_columns(with_audit_dispatch(tailed), host)


def with_header_columns(df: DataFrame, host: str | None = None, line: str = "msg") -> DataFrame:
    """Add ts, host and severity of raw audit records, as a syslog header would tell them."""
    head = F.explode(F.array(audit_header(line))).alias("_head")
    node = F.nullif(F.regexp_extract(F.col(line), r"^node=(\S+)", 1), F.lit(""))
    return (
        df.select("*", head)
        .withColumns(
            {
                "ts": F.timestamp_millis(header_fields(F.col("_head"))["epoch_ms"]),
                "host": F.coalesce(node, F.lit(host).cast("string")),
                "severity": F.lit(_NOTICE),
            }
        )
        .drop("_head")
    )


def with_audit_dispatch(df: DataFrame, facility: str = "local3") -> DataFrame:
    """Give audit records the facility they carry when they enter syslog."""
    return df.withColumn("facility", facility_number(F.lit(facility))).withColumn(
        "facility_text", F.lit(facility)
    )


def read_syslog(
    spark: SparkSession, path: str, stream: bool = False, year: int | None = None
) -> DataFrame:
    """Landed syslog files, parsed."""
    return parse_syslog(_lines(spark, path, stream), year=year)


def read_messages(
    spark: SparkSession,
    path: str,
    tag: str = "messages",
    stream: bool = False,
    year: int | None = None,
) -> DataFrame:
    """System message files as a second source; ``tag`` tells it apart."""
    return read_syslog(spark, path, stream, year).withColumn("source", F.lit(tag))


def parse_syslog(df: DataFrame, line: str = "value", year: int | None = None) -> DataFrame:
    """Add pri, facility, severity, ts, host, program, pid and msg.

    A line that is no syslog line keeps its text in ``msg`` and NULL elsewhere.

    Nearly all headers are three words, which are checked and cut without
    touching the message; any other line goes through the whole header pattern.
    """
    text = F.col(line)
    staged = df.withColumn("_head", header_words(line)).withColumn(
        "_short", is_short(F.col("_head"), text)
    )
    # The one-element explode keeps later filters above the parse; pushed below
    # it they would run the header patterns a second time per line.
    parts = F.when(~F.col("_short"), capture(line, HEADER, 7))
    staged = staged.select("*", F.explode(F.array(parts)).alias("_parts"))
    short, long = short_fields(F.col("_head"), text), long_fields(F.col("_parts"))
    field = {n: F.when(F.col("_short"), short[n]).otherwise(long[n]) for n in short}
    return (
        staged.withColumns(
            {
                "pri": field["pri"].try_cast("int"),
                "ts": syslog_time(field["time"], year),
                "host": field["host"],
                "program": field["program"],
                "pid": field["pid"].try_cast("int"),
                "msg": F.coalesce(field["msg"], text),
            }
        )
        .drop("_head", "_short", "_parts")
        .withColumns({"facility": facility_of(F.col("pri")), "severity": severity_of(F.col("pri"))})
        .withColumn("facility_text", facility_text("facility"))
    )


def read_received(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """What the receiver wrote: ``TIME HOST TAG MSG``."""
    return parse_received(_lines(spark, path, stream))


def parse_received(df: DataFrame, line: str = "value") -> DataFrame:
    """Add ts, host, tag and msg of a received line."""
    parts = F.col("_parts")
    return (
        df.withColumn("_parts", F.split(F.col(line), " ", 4))
        .withColumns(
            {
                "ts": F.try_to_timestamp(F.get(parts, F.lit(0))),
                "host": F.get(parts, F.lit(1)),
                "tag": F.get(parts, F.lit(2)),
                "msg": F.get(parts, F.lit(3)),
            }
        )
        .drop("_parts")
    )


def parse_audit(df: DataFrame, line: str = "msg") -> DataFrame:
    """Add record_type, epoch_ms and serial of an audit record."""
    # Exploded for the reason given above: a filter on the header runs it once.
    head = F.explode(F.array(audit_header(line))).alias("_head")
    return (
        df.select("*", record_type(line).alias("record_type"), head)
        .withColumns(header_fields(F.col("_head")))
        .drop("_head")
    )


def drop_blank(df: DataFrame, line: str = "value") -> DataFrame:
    """Strip every line and leave out the empty ones."""
    return df.withColumn(line, strip(line)).filter(F.col(line) != "")


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of all sources under one schema; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
