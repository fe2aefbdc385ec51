"""Verdicts of the three lists, stated row by row."""

import pytest
from pyspark.sql import functions as F

from logforge.operators.verdicts import record_verdicts
from logforge.sources.rules import parse_rules

RULES = [
    "-a never,user -F uid=7", "-a always,user -F msgtype=USER_CMD", "-a never,user -F msgtype=USER_CMD -F auid=5", "-a never,user -F subj_type=crond_t",
    "-a exclude,always -F msgtype=CWD", "-a exclude,never -F msgtype=PATH -F uid=9", "-a always,exclude -F msgtype=A -F msgtype=B",
    "-w /etc/shadow -p x -k s", "-a never,exit -F arch=b64 -S all -F uid=1", "-a exit,always -F arch=b64 -S execve -k e",
]
CALL = "arch=c000003e syscall=59 success=yes exit=0 a0=1 a1=2 a2=3 a3=4 auid=5 euid=0 gid=0"
# type, text, serial, and what is wanted: list, idx, kept
CASES = [
    ("SYSCALL", CALL + " uid=0", 1, "exit", 9, True), ("EXECVE", 'argc=1 a0="ls"', 1, "exit", 9, True), ("CWD", "cwd=/", 1, "exclude", 4, False), ("PATH", 'name="/bin/ls" uid=9', 1, "exclude", 5, False),
    ("SYSCALL", CALL + " uid=1", 2, "exit", 8, False), ("PATH", 'name="/bin/ls"', 2, "exit", 8, False), ("PATH", 'name="/bin/ls"', 2, "exit", 8, False),
    # The watch comes before the rule that says never.
    ("SYSCALL", CALL + " uid=1", 3, "exit", 7, True), ("PATH", 'name="/etc/shadow"', 3, "exit", 7, True),
    ("SYSCALL", CALL.replace("=59", "=2") + " uid=0", 4, None, None, False), ("PROCTITLE", "proctitle=6C73", 4, None, None, False), ("PATH", "name=2F746D702FFF41", 4, None, None, False),
    ("PATH", 'name="/x"', 5, None, None, True), ("A", "uid=9", 6, None, None, True), ("AVC", "avc: denied", 2, None, None, True), ("USER_CMD", "uid=7 auid=5", 7, "user", 0, False),
    ("USER_CMD", "uid=8 auid=5", 7, "user", 1, True), ("USER_AUTH", "uid=8 auid=5", 7, None, None, True), ("CRED_ACQ", "uid=0 subj=system_u:system_r:crond_t:s0", 7, "user", 3, False),
    ("SYSCALL", CALL + " uid=0", None, None, None, True), (None, None, None, None, None, True), ("USER_CMD", None, None, "user", 1, True),
]
SCHEMA = "at INT, host STRING, epoch_ms BIGINT, serial BIGINT, record_type STRING, msg STRING, idx STRING, _hit INT"


def ruleset(spark, lines, name="r"):
    return parse_rules(spark.createDataFrame([(name, i, v) for i, v in enumerate(lines)], "ruleset STRING, idx INT, value STRING"))


def records(spark):
    return spark.createDataFrame([(i, "h", None if n is None else 1000 * n, n, k, t, "own", 3) for i, (k, t, n, *_) in enumerate(CASES)], SCHEMA)


def test_verdicts(spark):
    got = record_verdicts(records(spark), ruleset(spark, RULES))
    assert got.columns == ["at", "host", "epoch_ms", "serial", "record_type", "msg", "_hit", "list", "idx", "kept"]
    assert [(r.list, r.idx, r.kept) for r in got.orderBy("at").collect()] == [tuple(c[3:]) for c in CASES]


def test_without_rules_calls_go(spark):
    got = record_verdicts(records(spark), ruleset(spark, []))
    judged = {r.at for r in got.filter("NOT kept").collect()}
    assert judged == {i for i, (k, _, n, *_) in enumerate(CASES) if n in (1, 2, 3, 4) and k != "AVC"}
    assert got.filter("list IS NOT NULL").count() == 0 and record_verdicts(records(spark).limit(0), ruleset(spark, RULES)).count() == 0


def test_one_set(spark):
    with pytest.raises(ValueError):
        record_verdicts(records(spark), ruleset(spark, RULES).union(ruleset(spark, RULES, "s")))


def test_plan(spark, tmp_path):
    records(spark).write.parquet(str(tmp_path / "r"))
    df = record_verdicts(spark.read.parquet(str(tmp_path / "r")).withColumn("x", F.lit(1)), ruleset(spark, RULES))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Nested" not in plan and "Cartesian" not in plan and "Python" not in plan
