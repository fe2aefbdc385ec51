"""Counts and reports; every group merges before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from logforge.facts import UNWANTED_PROGRAMS
from logforge.functions.audit import audit_result, record_type


def received_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("received"))


def unwanted_report(
    df: DataFrame, programs=UNWANTED_PROGRAMS, line: str = "line"
) -> DataFrame:
    """Per unwanted program: was it seen in any received line, and in how many.

    All programs are tested in one pass over the lines.
    """
    counts = df.agg(
        *[
            F.count_if(F.contains(F.col(line), F.lit(p))).alias(f"n{i}")
            for i, p in enumerate(programs)
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(p).alias("program"), F.col(f"n{i}").alias("n_lines"))
            for i, p in enumerate(programs)
        ]
    )
    return counts.select(F.inline(rows)).withColumn("seen", F.col("n_lines") > 0)


def unwanted_count(df: DataFrame, programs=UNWANTED_PROGRAMS, line: str = "line") -> DataFrame:
    """Number of unwanted programs seen at all."""
    return unwanted_report(df, programs, line).agg(
        F.count_if(F.col("seen")).alias("unwanted_programs")
    )


def volume_since(df: DataFrame, since: Column, time: str = "ts") -> DataFrame:
    """Number of lines from ``since`` on."""
    return df.filter(F.col(time) >= since).agg(F.count(F.lit(1)).alias("n_lines"))


def undated(df: DataFrame, ts: str = "ts", keys: tuple[str, ...] = ("host",)) -> DataFrame:
    """Lines without a time per key: the reports by time leave them out."""
    return df.filter(F.col(ts).isNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines"))


def events_per_second(
    df: DataFrame, width: str = "1 minute", keys: tuple[str, ...] = ("host",), time: str = "ts"
) -> DataFrame:
    """Lines per time window and key, with the rate per second."""
    seconds = "unix_timestamp(window.end) - unix_timestamp(window.start)"
    return (
        df.groupBy(F.window(time, width).alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .withColumn("eps", F.col("n_lines") / F.expr(seconds))
    )


def sliding_counts(
    df: DataFrame, width: str = "10 minutes", slide: str = "5 minutes", keys: tuple[str, ...] = ("host",), time: str = "ts"
) -> DataFrame:
    """Lines per overlapping time window and key; a line counts in every window it lies in.

    Lines are counted per slide first, so only counts are repeated for the windows; ``width`` is a multiple of ``slide``.
    """
    part = df.groupBy(F.window(time, slide).alias("part"), *keys).agg(F.count(F.lit(1)).alias("n"))
    at = part.select(F.col("part.start").alias("_at"), *keys, "n")
    return at.groupBy(F.window("_at", width, slide).alias("window"), *keys).agg(F.sum("n").alias("n_lines"))


def bursts(df: DataFrame, gap_s: int, keys: tuple[str, ...] = ("host",), us: str = "us") -> DataFrame:
    """Bursts of lines per key: no two successive lines of one are further apart than ``gap_s`` seconds.

    Gives (keys, first_us, last_us, n_lines).  Lines of one second merge before
    the shuffle, so a key with a third of all lines costs as many rows as it has
    seconds.  Lines without a time are left out.
    """
    if gap_s < 1:
        raise ValueError("a gap of at least one second")
    second = F.floor(F.col(us) / 1_000_000).alias("_s")
    merged = df.filter(F.col(us).isNotNull()).groupBy(*keys, second)
    merged = merged.agg(F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.count(F.lit(1)).alias("n_lines"))
    w = Window.partitionBy(*keys).orderBy("_s")
    new = F.coalesce(F.col("first_us") - F.lag("last_us").over(w) > gap_s * 1_000_000, F.lit(True))
    runs = merged.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy(*keys, "_run").agg(
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("n_lines").alias("n_lines")
    ).drop("_run")


def volume_reduction(df: DataFrame) -> DataFrame:
    """Lines per route and program with subtotals (NULL stands for "all")."""
    return df.rollup("route", "program").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.grouping_id().alias("level"),
    )


def technique_counts(
    df: DataFrame, keys: tuple[str, ...] = (), user: str | None = None
) -> DataFrame:
    """Lines (and distinct users) per technique and further keys."""
    counts = [F.count(F.lit(1)).alias("n_lines")]
    if user:
        counts.append(F.count_distinct(user).alias("n_users"))
    # A plain explode would add a filter on the whole tagging expression.
    rows = df.select(
        *keys, *([user] if user else []), F.explode_outer("techniques").alias("technique")
    )
    return (
        rows.filter(F.col("technique").isNotNull())
        .groupBy(*keys, "technique")
        .agg(*counts)
    )


def result_ratio(df: DataFrame, keys: tuple[str, ...] = ("record_type",), line: str = "msg") -> DataFrame:
    """Failed and succeeded records per key; the ratio is in per mille, rounded down."""
    if "record_type" in keys and "record_type" not in df.columns:
        df = df.withColumn("record_type", record_type(line))
    failed = F.count_if(F.col("_result") == "failed")
    total = F.count(F.lit(1))
    return (
        df.withColumn("_result", audit_result(line))
        .groupBy(*keys)
        .agg(
            total.alias("n_lines"),
            failed.alias("n_failed"),
            F.floor(failed * 1000 / total).alias("failed_per_mille"),
        )
    )


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties in the order of the value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .orderBy(F.col("n_lines").desc(), F.col(column))
        .limit(k)
    )


def rules_inventory(rules: DataFrame) -> DataFrame:
    """Rules per rule set, kind and key."""
    return rules.groupBy("ruleset", "kind", "key").agg(F.count(F.lit(1)).alias("n_rules"))
