"""Stream runs that lose nothing: open rows are carried over, late rows have an output of their own, and a run can be closed.

An aggregation under a watermark drops late rows and keeps what the watermark
has not passed.  Here every micro-batch is dealt into late rows, closed rows and
open ones.  Closed rows go through a batch operator, so a stream gives what the
batch job gives, hot keys included; open rows wait in a table.  Each batch writes
folders of its own, so a replay overwrites them, and removes those that no replay
can need any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logforge.streaming.run import each_batch, write_batch

Operator = Callable[[DataFrame], DataFrame]
DELAY_MS = 600_000


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of a finished batch in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _folder(out: str, part: str, batch_id: int) -> str:
    return f"{out}/{part}/batch_id={batch_id}"


def carry_stream(
    rows: DataFrame,
    finish: Operator,
    out: str,
    checkpoint: str,
    delay_ms: int = DELAY_MS,
    time: str = "epoch_ms",
) -> StreamingQuery:
    """Run ``finish`` over the rows whose time the mark has passed; the mark is ``delay_ms`` behind the newest time.

    ``out/done`` has the operator's rows, ``out/late`` rows that came after the
    mark had passed them, ``out/open`` those still waiting.  Rows of one group
    must have one time, or ``finish`` see them apart.  Rows without a time are
    never late and pass at once.
    """
    schema = rows.schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Written once: a source is read once a batch.
        write_batch(batch, f"{out}/in", batch_id)
        batch = spark.read.schema(schema).parquet(_folder(out, "in", batch_id))
        floor, live, late = None, batch, batch.limit(0)
        if batch_id > 0:
            floor = spark.read.parquet(_folder(out, "mark", batch_id - 1)).first()[0]
            carried = spark.read.schema(schema).parquet(_folder(out, "open", batch_id - 1))
            if floor is not None:
                is_late = F.coalesce(F.col(time) < floor, F.lit(False))
                late, live = batch.filter(is_late), batch.filter(~is_late)
            live = live.unionByName(carried)
        newest = batch.agg(F.max(time)).first()[0]  # one number
        mark = max((m for m in (floor, None if newest is None else newest - delay_ms) if m is not None), default=None)
        still_open: Column = F.col(time).isNotNull() if mark is None else F.coalesce(F.col(time) >= mark, F.lit(False))
        write_batch(late, f"{out}/late", batch_id)
        write_batch(finish(live.filter(~still_open)), f"{out}/done", batch_id)
        write_batch(live.filter(still_open), f"{out}/open", batch_id)
        write_batch(spark.createDataFrame([(mark,)], "mark long"), f"{out}/mark", batch_id)
        remove_folder(spark, _folder(out, "in", batch_id))
        for part in ("open", "mark"):
            if batch_id > 1:
                remove_folder(spark, _folder(out, part, batch_id - 2))

    return each_batch(rows, handle, checkpoint)


def close_stream(spark: SparkSession, finish: Operator, out: str) -> DataFrame:
    """End a run: what is still open goes through ``finish`` too.  Returns all finished rows; closing again changes nothing."""
    marks = spark.read.parquet(f"{out}/mark")
    last = marks.agg(F.max("batch_id")).first()[0]  # one number
    left = spark.read.parquet(_folder(out, "open", last))
    write_batch(finish(left), f"{out}/done", last + 1)
    return spark.read.parquet(f"{out}/done").drop("batch_id")


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """Rows that came too late, with the batch that brought them."""
    return spark.read.parquet(f"{out}/late")
