"""Bursts closed by timers against the batch report; quiet keys leave no state."""

import random

from pyspark.sql import functions as F

from logforge.operators.reports import bursts
from logforge.streaming.activity import activity_stream, merged, open_activity, timed_state
from logforge.streaming.run import append_files


def test_merged():
    assert merged([(9, 9, 1), (0, 2, 2), (3, 4, 1)], 1) == [(0, 4, 3), (9, 9, 1)]
    assert merged([(0, 9, 2), (1, 2, 1), (19, 19, 1)], 10) == [(0, 19, 4)] and merged([], 5) == []


def test_bursts_of_a_stream(spark, tmp_path):
    rng = random.Random(1)
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    for batch in range(3):
        # Out of order within a batch and by up to 20 s between batches; one key has most lines.
        start = batch * 300
        rows = [(rng.choice(("hot", "hot", "hot", "a", None)), (start + rng.uniform(-20, 300))) for _ in range(150)]
        rows += [("once", 3.0)] * (batch == 0) + [("late", 1000.0)] * (batch == 2)
        df = spark.createDataFrame(rows, "host STRING, s DOUBLE").select("host", (F.col("s") * 1_000_000).cast("long").alias("us"))
        df.filter("us >= 0").coalesce(1).write.mode("append").parquet(path)
    lines = spark.readStream.schema("host STRING, us LONG").option("maxFilesPerTrigger", 1).parquet(path)
    with timed_state(spark):
        df = activity_stream(lines, ["host"], 5, "30 seconds")
        append_files(df, str(tmp_path / "o"), checkpoint).awaitTermination()
        closed, left = spark.read.schema(df.schema).parquet(str(tmp_path / "o")), open_activity(spark, checkpoint, ["host"])
        got, kept = sorted(map(repr, map(tuple, closed.union(left).collect()))), left.collect()
    want = bursts(spark.read.parquet(path), 5).select("host", "first_us", "last_us", "n_lines")
    assert got == sorted(map(repr, map(tuple, want.collect())))
    # The mark stands at 970 s: only the newest burst is held.
    assert [r.host for r in kept] == ["late"]
