import json

import pytest
from pyspark.sql import functions as F

from logforge.plans.flow import process_lines
from logforge.scale import work_dir
from logforge.sources import logs as L
from logforge.sources.lookups import ignored_programs, read_accounts, read_lookup


def test_read_audit(spark, tmp_path):
    (tmp_path / "audit.log").write_text("type=A msg=audit(1.0:2): x\ntype=B\n")
    rows = L.read_audit(spark, str(tmp_path / "audit.log")).orderBy("msg").collect()
    assert [(r["program"], r["facility"], r["facility_text"]) for r in rows] == [("audit-direct", 19, "local3")] * 2
    assert rows[0]["source_file"].endswith("audit.log")


def test_read_syslog_and_messages(spark, tmp_path):
    (tmp_path / "m.log").write_text("Jan  2 03:04:05 h sshd[1]: hello\n")
    row = L.read_messages(spark, str(tmp_path), year=2024).first()
    assert (row["host"], row["program"], row["msg"], row["source"]) == ("h", "sshd", "hello", "messages")


def test_read_received(spark, tmp_path):
    (tmp_path / "r.log").write_text("2024-01-01T00:00:00Z h tag: msg one\n")
    assert L.read_received(spark, str(tmp_path)).first()["msg"] == "msg one"


def test_read_lookup(spark, tmp_path):
    table = [{"index": "cups", "value": "IGNORE"}, {"index": "x", "value": "PASS"}]
    (tmp_path / "t.json").write_text(json.dumps({"version": 1, "nomatch": "PASS", "type": "string", "table": table}, indent=1))
    assert sorted(map(tuple, read_lookup(spark, str(tmp_path / "t.json")).collect())) == [("cups", "IGNORE"), ("x", "PASS")]
    assert ignored_programs(spark).filter("program = 'systemd-logind'").count() == 1


def test_read_accounts_takes_host_from_path(spark, tmp_path):
    for host, text in (("web1", "root:x:0:0::/root:/bin/sh\nbob:x:1000:1::/:/x\n"), ("web2", "adm:x:0:0:::\n# c\n")):
        (tmp_path / host).mkdir()
        (tmp_path / host / "passwd").write_text(text)
    got = sorted((r["host"], r["id"], r["name"]) for r in read_accounts(spark, f"{tmp_path}/*/passwd").collect())
    assert got == [("web1", 0, "root"), ("web1", 1000, "bob"), ("web2", 0, "adm")]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "at INT, host STRING")
    b = spark.createDataFrame([(2, "y")], "at INT, tag STRING")
    assert sorted((r["at"], r["host"], r["tag"]) for r in L.union_sources(a, b).collect()) == [(1, "x", None), (2, None, "y")]


def test_whole_flow(spark):
    lines = [
        '<158>2024-01-01T00:00:00Z h audit: type=EXECVE argc=2 a0="curl" a1="x" uid=0',
        "<78>2024-01-01T00:00:00Z h CRON: x",
        "<13>2024-01-01T00:00:00Z h app: x",
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value STRING")
    ids = spark.createDataFrame([("h", 0, "root")], "host STRING, id BIGINT, name STRING")
    rows = process_lines(df, passwd=ids, groups=ids).collect()
    assert [r["line_out"] for r in rows] == ['type=EXECVE uid=0 cmd="curl x" uid_name="root" mitre_techniques="T1071"']
    assert process_lines(df, keep=("FORWARD", "DEFAULT")).count() == 2


def test_work_dir_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a.startswith(base) and a != b


def test_parse_runs_once_under_a_filter(spark):
    df = spark.createDataFrame([("<13>2024-01-01T00:00:00Z h app: x",)], "value STRING")
    plan = L.parse_syslog(df).filter(F.col("host") == "h")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
