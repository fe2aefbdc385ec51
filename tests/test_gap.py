"""Gaps of a stream against a count in plain Python."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from logforge.streaming.activity import timed_state
from logforge.streaming.gap import closed_gap, gap_stream, newest_mark, open_gap
from logforge.streaming.run import append_files

SCHEMA = "host STRING, s LONG, msg STRING"


def run(spark, base, sent, received, bound):
    sources = []
    for name, batches in (("sent", sent), ("received", received)):
        for rows in batches:
            df = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds("s"))
            df.coalesce(1).write.mode("append").parquet(f"{base}/{name}")
        source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{name}")
        sources.append(source)
    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    with newest_mark(spark):
        df = gap_stream(*sources, bound)
        append_files(df, f"{base}/out", f"{base}/c").awaitTermination()
    spark.conf.set("spark.sql.shuffle.partitions", shuffled)
    emitted = spark.read.schema(df.schema).parquet(f"{base}/out")
    left = open_gap(spark, f"{base}/c")
    rows = lambda d: sorted((r.host, int(r.ts.timestamp()), r.digest, r.sent, r.received, r.missing) for r in d.collect())
    return rows(closed_gap(emitted, left)), rows(emitted), rows(left)


def want(sent, received):
    sent, received = Counter(sent), Counter(received)
    texts = {m: hashlib.sha256(m.encode()).hexdigest() if m is not None else "" for _, _, m in sent}
    return sorted((h or "", s, texts[m], n, received[h, s, m], n - received[h, s, m]) for (h, s, m), n in sent.items() if n > received[h, s, m])


def test_gap_of_a_stream(spark, tmp_path):
    rng = random.Random(3)
    sent, received, in_time = [], [[], [], []], []
    for batch in range(3):
        rows = [(rng.choice(("hot", "hot", "a", None)), batch * 1000 + rng.randrange(900), rng.choice(("m", "n", "o", None))) for _ in range(200)]
        rows += [("hot", batch * 1000 + 5, "flood")] * 300
        sent.append(rows)
        for row in rows:
            turn = rng.choice((batch, batch, min(batch + 1, 2), min(batch + 2, 2), None))
            if turn is not None:
                received[turn].append(row)
                # The mark of a turn closes lines after it has been read; two turns later they are too late.
                if turn < batch + 2 or row[1] > max(r[1] for r in rows) - 800:
                    in_time.append(row)
    received[2].append(("never sent", 2000, "x"))
    got, emitted, left = run(spark, str(tmp_path), sent, received, "800 seconds")
    assert got == want([r for rows in sent for r in rows], in_time)
    assert emitted and left and len(emitted) + len(left) >= len(got)


def test_receiver_without_lines_state_on_disk(spark, tmp_path):
    sent = [[("h", 100, "a"), ("h", 100, "a")], [("h", 5000, "b")]]
    with timed_state(spark):
        got, emitted, left = run(spark, str(tmp_path), sent, [[]], "60 seconds")
    assert got == want([r for rows in sent for r in rows], [])
    # The outage is told while it lasts: only the newest line still has time.
    assert [r[1] for r in emitted] == [100] and [r[1] for r in left] == [5000]


def test_nothing_sent(spark, tmp_path):
    assert run(spark, str(tmp_path), [[]], [[("h", 1, "a")]], "60 seconds") == ([], [], [])
