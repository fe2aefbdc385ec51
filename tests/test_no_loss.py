"""Odd lines keep their content: field values, results, rendering, searches and streams."""

from pyspark.sql import functions as F

from logforge.functions import render as N
from logforge.functions.audit import event_result, field_value
from logforge.operators.events import assemble_events, event_paths, search_events
from logforge.operators.reports import undated
from logforge.streaming.run import append_files, dedup_stream, rate_cap_stream


def test_field_values(texts):
    df = texts(
        'name="/tmp/my file" comm="Web Content"', 'key=(null)\x1dARCH=x86_64 SYSCALL=open', "key=(null)", 'comm="(null)"',
        "comm=57656220436F6E74656E74 exe=2F62696E2F61622063\x1dX=1", 'name="ABCD" comm="41"', "auid=1000\x1dAUID=\"joe\"", 'name="" uid=', "hostname=x nametype=NORMAL", None,
    )
    names = ("name", "comm", "exe", "key", "auid")
    got = [tuple(r) for r in df.orderBy("at").select(*[field_value("msg", n) for n in names]).collect()]
    none = (None,) * 5
    assert got == [
        ("/tmp/my file", "Web Content", None, None, None), none, none, (None, "(null)", None, None, None), (None, "Web Content", "/bin/ab c", None, None),
        ("ABCD", "41", None, None, None), (None, None, None, None, "1000"), none, none, none,
    ]


def test_results(texts):
    df = texts("success=yes exit=0", "success=no", "x res=success'", "res=failed", "res=1", "item=0 name=x", None)
    assert [r[0] for r in df.orderBy("at").select(event_result("msg")).collect()] == [0, 1, 0, 1, 0, None, None]


RECORDS = [
    ("SYSCALL", 'success=yes comm="ls" uid=0', 1), ("EXECVE", 'argc=1 a0="ls"', 1), ("PATH", 'item=0 name="/tmp/a b" nametype=NORMAL', 1),
    ("PATH", "item=1 name=2F746D702F6320 nametype=PARENT", 1), ("PATH", 'item=1 name="/tmp/d" nametype=NORMAL', 2), ("PATH", 'item=1 name="/tmp/d" nametype=NORMAL', 2),
    ("CWD", "cwd=/", None),
]


def records(spark):
    rows = [("h", None if n is None else 1000 * n, n, k, t) for k, t, n in RECORDS]
    return spark.createDataFrame(rows, "host STRING, epoch_ms BIGINT, serial BIGINT, record_type STRING, msg STRING")


def test_events(spark):
    got = {r.serial: r for r in assemble_events(records(spark)).collect()}
    assert got[1].failed == 0 and got[2].failed is None and got[1].path == "/tmp/a b" and got[1].comm == "ls"
    paths = sorted((r.serial, r.item, r.path, r.nametype) for r in event_paths(records(spark)).collect())
    assert paths == [(1, 0, "/tmp/a b", "NORMAL"), (1, 1, "/tmp/c ", "PARENT"), (2, 1, "/tmp/d", "NORMAL")]


def test_search_events(spark):
    find = lambda **c: sorted(r.serial for r in search_events(records(spark), **c).collect())
    assert find(record_type="PATH", comm="ls") == [1] * 4 and find(record_type="PATH") == [1] * 4 + [2] * 2
    assert find(comm="none") == [] and find() == [1] * 4 + [2] * 2 and find(start_ms=2000, record_type="PATH") == [2] * 2


def test_rendering_without_parts(spark):
    df = spark.createDataFrame([(None, None, None, None, None, "text"), (None, 4, 5, "h", "p", None)], "ts TIMESTAMP, facility INT, severity INT, host STRING, program STRING, msg STRING")
    got = [tuple(r) for r in df.select(N.rfc3339(), N.received(), N.traditional()).collect()]
    assert got == [("<13>- - -: text", "- - - text", "- - -: text"), ("<37>- h p: ", "- h p ", "- h p: ")]
    assert [tuple(r) for r in undated(df).orderBy("host").collect()] == [(None, 1), ("h", 1)]


def test_no_cap_in_a_stream(spark, tmp_path):
    for k in range(3):
        spark.range(10).withColumn("host", F.lit("h")).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    source = spark.readStream.schema("id BIGINT, host STRING").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    for cap, want in ((0, 30), (12, 12)):
        out = str(tmp_path / f"out-{cap}")
        rate_cap_stream(source, ["host"], ["id"], cap, out, f"{out}-state").awaitTermination()
        assert spark.read.parquet(f"{out}/kept").count() == want


def test_headerless_lines_pass_a_stream(spark, tmp_path):
    records(spark).withColumn("program", F.lit("audit")).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(records(spark).withColumn("program", F.lit("")).schema).parquet(str(tmp_path / "in"))
    append_files(dedup_stream(source), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert [r.msg for r in spark.read.parquet(str(tmp_path / "out")).where("serial IS NULL").collect()] == ["cwd=/"]


def test_undecided_rules_are_named(spark):
    from logforge.operators.rule_match import unsupported_rules
    from logforge.sources.rules import parse_rules

    lines = [
        "-w /etc/passwd -p wa -k id", "-a always,exit -F arch=b64 -S execve -F auid>=1000 -F auid!=unset -k a", "-a always,exit -S all -C uid!=euid -k b",
        "-a never,exit -S all -F uid=chrony", "-a always,exit -S open -F exit=-EACCES -k c", "-a always,exit -S open -F exe=/bin/x -F a0&0x40", "-a always,task -F uid=0", "-a never,user -F uid=0",
        "-a always,exit -S open -F devmajor=3 -C uid=gid", "-a always,exit -S open -F uid=root",
    ]
    rules = parse_rules(spark.createDataFrame([("r", i, v) for i, v in enumerate(lines)], "ruleset STRING, idx INT, value STRING"))
    got = {r.idx: r.tests for r in unsupported_rules(rules).collect()}
    # Fields against fields, programs and root are decided.
    assert got == {3: ["uid=chrony"], 6: ["list=task"], 8: ["devmajor=3"]}


def test_large_cap(spark):
    from logforge.operators.reduce import rate_cap

    df = spark.range(9000).select(F.when(F.col("id") < 7000, "hot").otherwise("cold").alias("host"), (F.col("id") * 7919 % 9000).alias("at"))
    kept = rate_cap(df, ["host"], ["at"], 1500)
    want = {(r.host, r.at) for r in df.collect()}
    want = {(h, a) for h in ("hot", "cold") for a in sorted(a for k, a in want if k == h)[:1500]}
    assert {(r.host, r.at) for r in kept.collect()} == want and kept.columns == df.columns
    assert sorted(r.n for r in rate_cap(df, ["host"], ["at"], 1500, rank="n").where("host = 'hot'").collect()) == list(range(1, 1501))
