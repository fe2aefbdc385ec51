"""Order-dependent reduction: repeated messages, rate caps, last lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _differs(message: str, window) -> Column:
    return (~F.col(message).eqNullSafe(F.lag(message).over(window))) | (
        F.row_number().over(window) == 1
    )


def reduce_repeats(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    message: str = "msg",
    partitions: int | None = None,
) -> DataFrame:
    """Collapse runs of equal consecutive messages to one row with a count.

    Result: keys, ``message``, ``repeats``, ``first_<c>`` and ``last_<c>`` for
    every order column.  ``order`` must be unique within a key.
    """
    rows = df.select(
        *keys, *order, message, F.lit(1).cast("bigint").alias("repeats"),
        *[F.col(c).alias(f"first_{c}") for c in order],
    )
    return _collapse(rows, keys, order, message, partitions)


def extend_repeats(
    runs: DataFrame,
    df: DataFrame,
    keys: list[str],
    order: list[str],
    message: str = "msg",
    partitions: int | None = None,
) -> DataFrame:
    """Continue earlier runs (rows of ``reduce_repeats``) with new messages."""
    firsts = [f"first_{c}" for c in order]
    earlier = runs.select(
        *keys, *[F.col(f"last_{c}").alias(c) for c in order], message, "repeats", *firsts
    )
    rows = df.select(
        *keys, *order, message, F.lit(1).cast("bigint").alias("repeats"),
        *[F.col(c).alias(f"first_{c}") for c in order],
    )
    return _collapse(earlier.unionByName(rows), keys, order, message, partitions)


def _collapse(
    rows: DataFrame, keys: list[str], order: list[str], message: str, partitions: int | None
) -> DataFrame:
    """Runs of equal messages; every input row already stands for ``repeats`` messages.

    A run is defined by the order within a key, but a single key may hold a
    large part of all rows, so no task may own a whole key.  The rows are cut
    into contiguous chunks by range partitioning on key and order, runs are
    built inside each chunk, and only the first and last run of a chunk can
    continue in a neighbour: those (two rows per chunk and key) are stitched.
    """
    ranged = [*keys, *order]
    chunks = (
        rows.repartitionByRange(partitions, *ranged)
        if partitions
        else rows.repartitionByRange(*ranged)
    ).select(
        *keys, *order, message, "repeats",
        F.struct(*[f"first_{c}" for c in order]).alias("_first"),
        F.spark_partition_id().alias("_chunk"),
    )

    inside = Window.partitionBy("_chunk", *keys).orderBy(*order)
    numbered = chunks.withColumn("_new", _differs(message, inside).cast("int")).withColumn(
        "_run", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    runs = numbered.groupBy("_chunk", *keys, "_run").agg(
        F.first(message).alias(message),
        F.sum("repeats").alias("repeats"),
        F.min("_first").alias("_first"),
        F.max(F.struct(*order)).alias("_last"),
    )
    runs = runs.withColumn(
        "_edge",
        (F.col("_run") == 1)
        | (F.col("_run") == F.max("_run").over(Window.partitionBy("_chunk", *keys))),
    )
    # Edge runs of a key meet in one group (-1); inner runs stay with their chunk.
    runs = runs.withColumn("_group", F.when(F.col("_edge"), -1).otherwise(F.col("_chunk")))
    across = Window.partitionBy(*keys, "_group").orderBy("_last")
    same = (
        F.col("_edge")
        & F.col(message).eqNullSafe(F.lag(message).over(across))
        & (F.col("_chunk") != F.lag("_chunk").over(across))
    )
    stitched = runs.withColumn(
        "_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)
    ).withColumn(
        "_run", F.sum("_new").over(across.rowsBetween(Window.unboundedPreceding, 0))
    )
    merged = stitched.groupBy(*keys, "_group", "_run").agg(
        F.first(message).alias(message),
        F.sum("repeats").alias("repeats"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )
    return merged.select(
        *keys,
        message,
        "repeats",
        *[F.col(f"_first.first_{c}").alias(f"first_{c}") for c in order],
        *[F.col(f"_last.{c}").alias(f"last_{c}") for c in order],
    )


# Spark's default for spark.sql.optimizer.windowGroupLimitThreshold.
GROUP_LIMIT = 1000
CAP_PARTS = 64


def rate_cap(
    df: DataFrame, keys: list[str], order: list[str], per_group: int, rank: str | None = None
) -> DataFrame:
    """Keep the first ``per_group`` rows of each key (for example host and second).

    Up to Spark's threshold for group limits (1,000 rows) every task drops rows
    beyond the cap before the shuffle, so a hot second ships at most the cap
    per task.  A larger cap is applied to parts of each key first, which spread
    a hot one over ``CAP_PARTS`` tasks, and then to what is left.
    """
    if per_group <= 0:  # zero stands for "no cap"
        return df.withColumn(rank, F.lit(0)) if rank else df
    if per_group > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(*order), F.lit(CAP_PARTS))
        inside = Window.partitionBy(*keys, "_part").orderBy(*order)
        df = df.withColumn("_part", part).withColumn("_at", F.row_number().over(inside))
        df = df.filter(F.col("_at") <= per_group).drop("_part", "_at")
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn("_at", F.row_number().over(window)).filter(F.col("_at") <= per_group)
    return kept.withColumnRenamed("_at", rank) if rank else kept.drop("_at")


def rate_cap_report(df: DataFrame, keys: list[str], per_group: int) -> DataFrame:
    """Rows kept and dropped per key under the cap."""
    n = F.col("n_rows")
    kept = F.least(n, F.lit(per_group)) if per_group > 0 else n
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(*keys, "n_rows", kept.alias("kept"), (n - kept).alias("dropped"))
    )


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The last ``n`` rows in the given order (one sorted heap per task)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
