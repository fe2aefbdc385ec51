"""Years of stamps without one, against dates that the stamps were made from; tailed audit files."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logforge.operators.enrich import dual_format, forwarded_fields
from logforge.sources.logs import read_audit
from logforge.sources.years import with_years

UTC = timezone.utc


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_years(spark, chunk):
    rng = random.Random(chunk)
    rows, want = [], {}
    for file, step in (("a", 9), ("b", 40), ("c", 1), ("d", 100)):
        now = datetime(2019, 11, 3, 4, 5, 6, tzinfo=UTC) + timedelta(days=rng.randrange(300))
        made = []
        for line in range(60):
            now += timedelta(days=rng.randrange(step), seconds=rng.randrange(5000))
            # Some lines are a little late, also over new year; some have no stamp.
            when = now - timedelta(days=rng.randrange(3)) if rng.random() < 0.2 else now
            made.append((line, when if rng.random() > 0.1 or line == 59 else None))
        made[-1] = (59, now)
        for line, when in made:
            stamp = when and f"{when:%b} {when.day:>2} {when:%H:%M:%S}"
            rows.append((file, line, stamp, now + timedelta(hours=5)))
            want[file, line] = when
    df = spark.createDataFrame(rows, "file STRING, line LONG, stamp STRING, written TIMESTAMP").repartition(5)
    got = {(r.file, r.line): r.s for r in with_years(df, ["file"], "line", chunk=chunk).select("file", "line", F.unix_seconds("ts").alias("s")).collect()}
    assert got == {k: None if v is None else int(v.timestamp()) for k, v in want.items()}


def test_years_of_odd_stamps(spark):
    rows = [("f", 0, "Dec 31 23:59:59"), ("f", 1, "no stamp"), ("f", 2, "Jan  1 00:00:00"), ("f", 3, "Feb 30 00:00:00"), ("g", 0, None)]
    df = spark.createDataFrame([(*r, datetime(2024, 3, 1, tzinfo=UTC)) for r in rows], "file STRING, line LONG, stamp STRING, written TIMESTAMP")
    got = [r.s for r in with_years(df, ["file"], "line").orderBy("file", "line").select(F.unix_seconds("ts").alias("s")).collect()]
    assert got == [int(datetime(2023, 12, 31, 23, 59, 59, tzinfo=UTC).timestamp()), None, int(datetime(2024, 1, 1, tzinfo=UTC).timestamp()), None, None]


def test_direct_tail(spark, tmp_path):
    (tmp_path / "audit.log").write_text('node=web1 type=EXECVE msg=audit(1704067200.500:7): argc=2 a0="ls" a1="-l"\ntype=EOE msg=audit(1704067201.000:8):\nbroken\n')
    tailed = read_audit(spark, str(tmp_path / "audit.log"), host="here")
    rows = tailed.orderBy("msg").select("host", "program", "facility", "severity", F.unix_millis("ts").alias("ms")).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, [("here", "audit-direct", 19, 5, None), ("web1", "audit-direct", 19, 5, 1704067200500), ("here", "audit-direct", 19, 5, 1704067201000)]))
    out = dual_format(forwarded_fields(tailed)).collect()
    assert len(out) == 6 and all(r.line_out for r in out)
    assert any("cmd=ls -l" in r.line_out for r in out if r.format == "leef")
