from pyspark.sql import functions as F

from logforge.functions import execve as X
from logforge.functions.audit import audit_result, record_type
from logforge.functions.registry import map_lines, register_functions
from logforge.operators.routing import route_selectors
from logforge.sources.sinks import write_events, write_lines


def test_sql_functions_equal_the_columns(spark, lines):
    register_functions(spark)
    df = lines.select(
        "msg",
        F.expr("audit_record_type(msg)").alias("a"), record_type("msg").alias("b"),
        F.expr("audit_result(msg)").alias("c"), audit_result("msg").alias("d"),
        F.expr("execve_command(msg)").alias("e"), X.command("msg").alias("f"),
    )
    assert df.filter("NOT (a <=> b AND c <=> d AND e <=> f)").count() == 0
    assert df.filter("e IS NOT NULL").count() > 0
    odd = spark.sql("""SELECT execve_command('type=EXECVE a10="z" a2=61FF62 a0="x" a0=""') AS a,
        execve_command('type=EXECVE a1=ABC') AS b""").first()
    assert odd["a"] == " a�b z" and odd["b"] is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_map_lines_drops_and_passes(spark):
    def parse(line):
        if line == "bad":
            raise ValueError(line)
        return None if line == "drop" else line.upper()

    df = spark.createDataFrame([(1, "a"), (2, "drop"), (3, "bad")], "at INT, value STRING")
    assert sorted(map(tuple, map_lines(df, parse).collect())) == [(1, "A"), (3, "bad")]


def test_write_lines_per_sink(spark, tmp_path):
    df = spark.createDataFrame([(0, 3, "k"), (10, 6, "a"), (1, 6, "x")], "facility INT, severity INT, line_out STRING")
    write_lines(route_selectors(df), str(tmp_path / "s"), by="sink")
    read = lambda s: sorted(r[0] for r in spark.read.text(str(tmp_path / f"s/sink={s}")).collect())
    assert read("kern.log") == ["k"] and read("auth.log") == ["a"] and read("syslog") == ["k", "x"]


def test_written_events_prune_by_type(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "record_type STRING, n INT")
    write_events(df, str(tmp_path / "e"))
    got = spark.read.parquet(str(tmp_path / "e")).filter("record_type = 'B'")
    assert [r["n"] for r in got.collect()] == [2]
    assert "PartitionFilters: [isnotnull(record_type" in got._jdf.queryExecution().executedPlan().toString()
