import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from logforge.operators import events as V
from logforge.operators import reports as P
from logforge.operators.reduce import extend_repeats, rate_cap, rate_cap_report, reduce_repeats, tail
from logforge.scale import left_lookup
from logforge.sources.logs import parse_audit, union_sources


@pytest.fixture
def records(spark):
    rows = [
        ("h1", 1, 'type=SYSCALL msg=audit(1.000:7): success=yes uid=5 auid=4294967295 comm="cat" key="T1003_x"'),
        ("h1", 2, 'type=EXECVE msg=audit(1.000:7): argc=2 a0="cat" a1="f"'),
        ("h1", 3, 'type=PATH msg=audit(1.000:7): item=1 name="/b"'),
        ("h1", 4, 'type=PATH msg=audit(1.000:7): item=0 name="/a"'),
        ("h2", 5, 'type=SYSCALL msg=audit(1.000:7): success=no uid=6 comm="ls" key=(null)'),
        ("h1", 6, "plain message"),
        ("h1", 7, "plain message"),
    ]
    return parse_audit(spark.createDataFrame(rows, "host STRING, at INT, msg STRING"))


def test_assembly(records):
    rows = {(r["host"], r["serial"]): r for r in V.assemble_events(records).collect()}
    one = rows[("h1", 7)]
    assert (one["n_records"], one["cmd"], one["path"], one["uid_id"], one["auid_id"]) == (4, "cat f", "/a", 5, None)
    assert one["key"] == "T1003_x" and one["comm"] == "cat"
    assert len(rows) == 2 and rows[("h2", 7)]["cmd"] is None


def test_search_by_key_returns_whole_events(records):
    at = lambda df: sorted(r["at"] for r in df.collect())
    assert at(V.search(records, key="T1003_x")) == [1, 2, 3, 4]
    assert at(V.search(records, key="T1003_x", record_type="PATH")) == [3, 4]
    assert at(V.search(records, key="T1003_x", whole_events=False)) == [1]
    assert at(V.search(records, record_type="SYSCALL", success="no", comm="ls", start_ms=1000)) == [5]
    assert at(V.search(records, start_ms=1001)) == []
    assert V.any_match(records, "plain").first()["found"] is True
    assert V.any_match(records.limit(0), "plain").first()["found"] is False


def test_dedup_keeps_plain_lines_and_prefers_one_source(records):
    both = union_sources(
        records.withColumn("program", F.lit("audit-direct")), records.withColumn("program", F.lit("audit"))
    )
    got = V.dedup_sources(both)
    assert got.filter("epoch_ms IS NOT NULL").groupBy("program").count().collect()[0].asDict() == {"program": "audit", "count": 5}
    assert got.filter("epoch_ms IS NULL").count() == 4


def test_delivery_gap_counts_copies(records):
    gap = V.delivery_gap(records, records.filter("at NOT IN (1, 7)"))
    got = sorted((r["host"], r["sent"], r["received"], r["missing"]) for r in gap.collect())
    assert got == [("h1", 1, 0, 1), ("h1", 2, 1, 1)]


def test_first_match(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, "z")], "e INT, idx INT, key STRING")
    assert sorted((r["e"], r["idx"], r["key"]) for r in V.first_match(df, ["e"], "idx").collect()) == [(1, 2, "b"), (2, 9, "z")]


def brute_runs(rows):
    out = []
    for key in sorted({r[0] for r in rows}):
        mine = sorted((r[1], r[2]) for r in rows if r[0] == key)
        for msg, run in groupby(mine, key=lambda r: r[1]):
            run = list(run)
            out.append((key, msg, len(run), run[0][0], run[-1][0]))
    return sorted(out, key=str)


def as_runs(df):
    return sorted(((r["k"], r["msg"], r["repeats"], r["first_at"], r["last_at"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("partitions", [1, 3, 8, 40])
def test_repeats_with_a_hot_key(spark, partitions):
    rng = random.Random(partitions)
    rows = []
    for at in range(600):
        key = "hot" if rng.random() < 0.8 else rng.choice("ab")
        rows.append((key, at, rng.choice(["x", "x", "x", "x", "y", None])))
    rows += [("same", 1000 + i, "m") for i in range(200)]  # one run over many chunks
    df = spark.createDataFrame(rows, "k STRING, at INT, msg STRING")
    got = as_runs(reduce_repeats(df, ["k"], ["at"], partitions=partitions))
    assert got == brute_runs(rows)


def test_repeats_continue(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), at, rng.choice("xy")) for at in range(300)]
    make = lambda r: spark.createDataFrame(r, "k STRING, at INT, msg STRING")
    first = reduce_repeats(make(rows[:100]), ["k"], ["at"])
    assert as_runs(extend_repeats(first, make(rows[100:]), ["k"], ["at"], partitions=6)) == brute_runs(rows)


def test_rate_cap(spark):
    rows = [("h", s, i) for s in range(3) for i in range(s * 4)]
    df = spark.createDataFrame(rows, "host STRING, second INT, serial INT")
    kept = rate_cap(df, ["host", "second"], ["serial"], 5)
    assert sorted((r["second"], r["serial"]) for r in kept.collect()) == [(1, i) for i in range(4)] + [(2, i) for i in range(5)]
    report = {r["second"]: (r["n_rows"], r["kept"], r["dropped"]) for r in rate_cap_report(df, ["host", "second"], 5).collect()}
    assert report == {1: (4, 4, 0), 2: (8, 5, 3)}
    assert rate_cap(df, ["host"], ["serial"], 0).count() == len(rows)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 5, Partial" in plan  # cut before the shuffle, too


def test_tail(spark):
    assert [r[0] for r in tail(spark.range(20), 3, ["id"]).collect()] == [19, 18, 17]


@pytest.mark.parametrize("how", ["left", "left_anti", "inner"])
def test_salted_lookup_equals_broadcast(spark, how):
    df = spark.range(500).selectExpr("id AS at", "IF(id % 3 = 0, NULL, IF(id % 2 = 0, 1, id)) AS k")
    dim = spark.range(0, 400, 7).selectExpr("id AS k", "id * 2 AS v")
    rows = lambda b: sorted(map(tuple, left_lookup(df, dim, ["k"], how, broadcast=b, salts=5).select("at", *(["v"] if how != "left_anti" else [])).collect()), key=str)
    assert rows(True) == rows(False)


def test_reports(spark):
    df = spark.createDataFrame([("a systemd x",), ("kernel: cron",), ("ok",)], "line STRING")
    seen = {r["program"]: (r["n_lines"], r["seen"]) for r in P.unwanted_report(df).collect()}
    assert seen["cron"] == (1, True) and seen["snapd"] == (0, False) and len(seen) == 6
    assert P.unwanted_count(df).first()[0] == 3
    eps = P.events_per_second(spark.sql("SELECT timestamp'2024-01-01 00:00:01' AS ts, 'h' AS host FROM range(30)"))
    assert eps.first()["eps"] == 0.5
