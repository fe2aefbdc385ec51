"""Years of traditional stamps, which have none: found from where months jump back along a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logforge.functions.render import utc_text

# Rows of a file that are looked at together.
CHUNK = 100_000
# Month names of the stamps.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _month(stamp: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(stamp, 1, 3)).cast("int")


def with_years(
    df: DataFrame, file: list[str], order: str, stamp: str = "stamp", written: str = "written", chunk: int = CHUNK
) -> DataFrame:
    """Add ``ts`` to lines with stamps ``Mon dd HH:MM:SS`` (UTC).

    ``order`` is the line's whole number in its file and ``written`` the file's
    own time.  Where a month falls by more than half a year against the line
    before, a year ends; lines a little out of order do not.  Where it rises by
    more than half a year, such a line looks back over new year.  The last line
    is dated so that it is not after the file's time, and each line before it by
    the years that end between.  Lines without a stamp get no time and are
    looked through; a day that its year has not gives none.

    Years are counted in chunks of a file's lines: within chunks first, then
    over one row a chunk, so a long file is no task of its own.
    """
    month = _month(F.col(stamp))
    rows = df.withColumn("_month", F.when(month > 0, month)).withColumn("_chunk", F.floor(F.col(order) / chunk))
    within = Window.partitionBy(*file, "_chunk").orderBy(order)
    seen = F.last("_month", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, -1))
    turn = lambda before, now: F.when(before - now > 6, 1).when(now - before > 6, -1).otherwise(0)
    rows = rows.withColumn("_turn", F.coalesce(turn(seen, F.col("_month")), F.lit(0)))
    rows = rows.withColumn("_here", F.sum("_turn").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    # One row a chunk: its turns, its first and last month and stamp.
    at = lambda f, c: f(F.when(F.col("_month").isNotNull(), F.struct(order, c)))[c]
    chunks = rows.groupBy(*file, "_chunk").agg(
        F.sum("_turn").alias("_turns"), at(F.min, "_month").alias("_first"), at(F.max, "_month").alias("_last"),
        at(F.max, stamp).alias("_stamp"), F.max(written).alias("_written"),
    )
    along = Window.partitionBy(*file).orderBy("_chunk")
    before = F.last("_last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    chunks = chunks.withColumn("_edge", F.coalesce(turn(before, F.col("_first")), F.lit(0)))
    total = F.sum(F.col("_turns") + F.col("_edge"))
    chunks = chunks.withColumn("_base", total.over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_turns"))
    whole = Window.partitionBy(*file)
    end = F.max(F.when(F.col("_stamp").isNotNull(), F.struct("_chunk", "_stamp", (F.col("_base") + F.col("_turns")).alias("n"))))
    chunks = chunks.withColumn("_end", end.over(whole)).withColumn("_written", F.max("_written").over(whole))
    year = F.substring(utc_text("_written"), 1, 4).cast("int")
    late = _stamped(F.col("_end._stamp"), year) > F.col("_written")
    chunks = chunks.withColumn("_year", year - F.when(late, 1).otherwise(0) - F.col("_end.n") + F.col("_base"))
    dated = rows.join(chunks.select(*file, "_chunk", "_year"), [*file, "_chunk"], "left")
    dated = dated.withColumn("ts", _stamped(F.col(stamp), (F.col("_year") + F.col("_here")).cast("int")))
    return dated.drop("_month", "_chunk", "_turn", "_here", "_year")


def _stamped(stamp: Column, year: Column) -> Column:
    parts = F.split(F.trim(F.regexp_replace(stamp, " +", " ")), " ")
    text = F.concat_ws(
        " ", F.concat_ws("-", year, F.lpad(_month(stamp).cast("string"), 2, "0"), F.lpad(F.get(parts, F.lit(1)), 2, "0")), F.get(parts, F.lit(2))
    )
    return F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit("yyyy-MM-dd HH:mm:ss XXX"))
