"""Mixing sources to target weights: Sainte-Lague quotas of equal-token blocks.

Only DataFrame operations.  Sizes are words; one small row per document and one
per source or shard is all that is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logforge.scale import work_dir

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add ``target`` to rows (source, source_size), one per source.

    Sources sorted by code point, null last, weigh ``weights`` in turn and share
    ``share`` times all sizes; no target is above ``most`` times the source's
    size, and what is above goes to the others by weight.  Filled sources come
    first by size per weight, so the level follows from running sums.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sources.withColumn("_weight", F.element_at(cycle, (F.row_number().over(order) - 1) % len(weights) + 1))
    rows = rows.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    by = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn(
        "_level",
        (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        / F.sum("_weight").over(after),
    )
    rows = rows.withColumn("_open", F.col("_cap") / F.col("_weight") > F.col("_level"))
    # Filled sources stand first; the level at the first open one holds for all open ones.
    rows = rows.withColumn("_rank", F.row_number().over(by))
    rows = rows.withColumn("_final", F.min(F.when(F.col("_open"), F.struct("_rank", "_level"))).over(everything))
    level = F.col("_final._level")
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("_weight")))
    return rows.withColumn("target", target).drop("_weight", "_cap", "_level", "_open", "_rank", "_final")


def apportion(rows: DataFrame, group: list[str], votes: str, seats: str, tie: list[str]) -> DataFrame:
    """Add ``quota``: the seats of each row by highest quotients votes / (2k + 1).

    ``seats`` is the same in all rows of a group.  Rounded ideal shares are at
    most half a seat a row off; only the missing or surplus seats are ranked by
    quotient, as many offers a row as the group lacks.  Ties go by ``tie``.
    """
    g = Window.partitionBy(*group)
    total = F.sum(votes).over(g)
    rows = rows.withColumn("_ideal", F.when(total > 0, F.floor(F.col(votes) * F.col(seats) / total + 0.5)).otherwise(0).cast("long"))
    rows = rows.withColumn("_lack", F.when(total > 0, F.col(seats) - F.sum("_ideal").over(g)).otherwise(0).cast("long"))
    step = F.explode_outer(F.when(F.col("_lack") != 0, F.sequence(F.lit(1), F.abs("_lack").cast("int"))))
    offers = rows.select("*", step.alias("_k"))
    add = F.col("_lack") > 0
    divisor = F.when(add, 2 * (F.col("_ideal") + F.col("_k")) - 1).otherwise(2 * (F.col("_ideal") - F.col("_k")) + 1)
    quotient = F.col(votes) / divisor
    offers = offers.withColumn("_valid", F.col("_k").isNotNull() & (divisor > 0) & (F.col(votes) > 0))
    rank = Window.partitionBy(*group).orderBy(
        F.col("_valid").desc(), F.when(add, -quotient).otherwise(quotient), *[F.col(c).asc_nulls_last() for c in tie], F.col("_k")
    )
    taken = F.col("_valid") & (F.row_number().over(rank) <= F.abs("_lack"))
    kept = [c for c in rows.columns if c not in ("_ideal", "_lack")]
    offers = offers.withColumn("_taken", F.when(taken, F.signum(F.col("_lack")).cast("long")).otherwise(0))
    return offers.groupBy(*kept).agg((F.max("_ideal") + F.sum("_taken")).alias("quota"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    shard_words: int = 200_000,
    block_words: int = 256,
    seed: int = 17,
) -> DataFrame:
    """What a mix takes of each document: id, source, size, source_size, target, taken.

    Equal-token blocks are allotted to sources by highest quotients of their
    targets, then, past whole rounds over a source, to its shards by their
    sizes.  Within a shard documents stand in an order made from ``seed`` and
    the shard's blocks are taken from its start; a document gets its words in
    the taken blocks.  A block has ``block_words`` words, fewer if the smallest
    source would not hold a hundred.

    Shards are hash parts of a source of about ``shard_words`` words, so a
    source of any size spreads.  Null texts and texts without words have size 0
    and give 0; a null source is a source, the last.  Equal ids are separate
    rows.  Sources without words get target 0.  No documents: no rows.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "mix")
    docs.select("doc_id", "source", n_words(F.col("text")).alias("size")).write.parquet(f"{base}/sizes")
    sized = spark.read.parquet(f"{base}/sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = water_fill(sources, weights, share, most)
    everything = Window.partitionBy()
    least = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(everything)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(least / 100))).cast("long")
    sources = sources.withColumn("block", F.coalesce(block, F.lit(1)).cast("long"))
    sources = sources.withColumn("_seats", F.round(F.sum("target").over(everything) / F.col("block")).cast("long")).withColumn("_all", F.lit(0))
    sources = apportion(sources, ["_all"], "target", "_seats", ["source"]).drop("_all", "_seats")
    wanted = F.least((F.col("quota") * F.col("block")).cast("double"), F.col("source_size") * F.lit(float(most)))
    sources = sources.withColumn("_wanted", wanted)
    sources = sources.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("_wanted") / F.col("source_size"))).otherwise(0).cast("long"))
    sources = sources.withColumn("_rest", F.round((F.col("_wanted") - F.col("rounds") * F.col("source_size")) / F.col("block")).cast("long"))
    sources = sources.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))
    sources.select("source", "source_size", "target", "block", "rounds", "_rest", "shards").write.parquet(f"{base}/sources")
    sources = spark.read.parquet(f"{base}/sources")

    place = F.xxhash64(F.lit(seed), F.col("doc_id"))
    # One row a source; the join is an ordinary one, and a hot source is split by the adaptive join.
    placed = sized.withColumnRenamed("source", "_s").join(sources, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    placed = placed.withColumn("_place", place).withColumn("shard", F.pmod(place, F.col("shards")))
    shards = placed.groupBy("source", "shard", "block", "_rest").agg(F.sum("size").alias("_words"))
    quotas = apportion(shards, ["source"], "_words", "_rest", ["shard"]).select(
        F.col("source").alias("_s"), F.col("shard").alias("_h"), F.least(F.col("quota") * F.col("block"), F.col("_words")).alias("_take")
    )
    inside = Window.partitionBy("source", "shard").orderBy("_place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(quotas, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_take") - F.col("_before")))
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("rounds") * F.col("size") + part).cast("long").alias("taken")
    )
