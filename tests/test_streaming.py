import random

import pytest
from pyspark.sql import functions as F

from logforge.functions.audit import is_execve
from logforge.operators.enrich import enrich_execve
from logforge.operators.events import assemble_events
from logforge.operators.reduce import rate_cap, reduce_repeats
from logforge.operators.routing import forwarded
from logforge.plans.fleet import fleet_lines
from logforge.sources.logs import parse_audit, parse_syslog, read_audit
from logforge.streaming import run as R

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The derived lines as four files in time order."""
    path = str(tmp_path_factory.mktemp("landed"))
    lines = fleet_lines(spark, SF)
    for i in range(4):
        part = lines.filter(F.expr(f"event_id div 250 = {i}")).coalesce(1)
        part.write.mode("append").parquet(path)
    return path


def stream(spark, path):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def batches(spark, path):
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def test_two_outputs_from_one_pass(spark, landed, tmp_path):
    parse = lambda df: parse_syslog(df.select("event_id", "line"), "line")
    query = R.run_stream(parse(stream(spark, landed)), str(tmp_path / "out"), str(tmp_path / "c"))
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 3
    want = forwarded(parse(spark.read.parquet(landed)))
    cols = ["event_id", "host", "msg"]
    assert rows(batches(spark, str(tmp_path / "out/raw")).select(cols)) == rows(want.select(cols))
    enriched = enrich_execve(want.filter(is_execve("msg"))).select("event_id", "line_out")
    assert rows(batches(spark, str(tmp_path / "out/enriched")).select("event_id", "line_out")) == rows(enriched)


def test_replayed_batch_overwrites(spark, tmp_path):
    for _ in range(2):
        R.write_batch(spark.range(5), str(tmp_path / "s"), 3)
    assert batches(spark, str(tmp_path / "s")).count() == 5


def test_repeats_across_batches(spark, landed, tmp_path):
    keys, order = ["host", "program"], ["us", "event_id"]
    out = str(tmp_path / "r")
    query = R.repeats_stream(stream(spark, landed), keys, order, out, str(tmp_path / "c"))
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 3
    got = R.repeats_so_far(spark, out)
    want = reduce_repeats(spark.read.parquet(landed), keys, order)
    assert rows(got.select(want.columns)) == rows(want)
    assert want.filter("repeats > 1").count() > 0


def test_rate_cap_across_batches(spark, tmp_path):
    path = str(tmp_path / "in")
    rng = random.Random(1)
    data = [("h", rng.randrange(3), i) for i in range(40)]
    for i in range(4):
        spark.createDataFrame(data[i * 10 : i * 10 + 10], "host STRING, second INT, serial INT").coalesce(1).write.mode("append").parquet(path)
    query = R.rate_cap_stream(
        stream(spark, path), ["host", "second"], ["serial"], 6, str(tmp_path / "o"), str(tmp_path / "c"), expire="second"
    )
    query.awaitTermination()
    want = rate_cap(spark.read.parquet(path), ["host", "second"], ["serial"], 6)
    assert rows(batches(spark, str(tmp_path / "o/kept")).select(want.columns)) == rows(want)


def test_assembly_emits_events_behind_the_watermark(spark, landed, tmp_path):
    df = R.assemble_stream(parse_audit(stream(spark, landed)), watermark="5 seconds")
    R.append_files(df, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    cols = ["host", "epoch_ms", "serial", "n_records", "cmd", "path", "key"]
    records = parse_audit(spark.read.parquet(landed))
    newest = records.agg(F.max("epoch_ms")).first()[0]
    want = assemble_events(records).filter(F.col("epoch_ms") <= newest - 5000)
    assert rows(spark.read.parquet(str(tmp_path / "o")).select(cols)) == rows(want.select(cols))


def test_late_lines_count_until_the_watermark(spark, tmp_path):
    path = str(tmp_path / "in")
    def land(*seconds):
        spark.createDataFrame([("h", s) for s in seconds], "host STRING, s BIGINT").select(
            "host", F.timestamp_seconds("s").alias("ts")
        ).coalesce(1).write.mode("append").parquet(path)
    land(0, 10, 70)
    land(20, 700)       # 20 is late but inside the watermark
    land(30, 2000)      # the test for lateness lags one batch, so 30 still counts
    land(40, 2100)      # 40 is behind the watermark: counted nowhere
    df = R.windowed_counts(stream(spark, path), "1 minute", watermark="10 minutes")
    out = df.select(F.unix_seconds("window.start").alias("start"), "n_lines")
    R.append_files(out, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "o"))) == [(0, 4), (60, 1), (660, 1)]


def test_dedup_of_two_streams(spark, landed, tmp_path):
    audit = parse_audit(stream(spark, landed)).filter("program = 'audit'")
    both = audit.unionByName(audit.withColumn("program", F.lit("audit-direct")))
    df = R.dedup_stream(both, watermark="5 seconds").select("event_id", "program", "epoch_ms")
    R.append_files(df, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o"))
    assert got.count() == got.select("event_id").distinct().count() > 500
    assert [r[0] for r in got.select("program").distinct().collect()] == ["audit"]


def test_text_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = 'type=EXECVE msg=audit(1.5:2): argc=1 a0="bash"\ntype=PATH msg=audit(1.5:2):\n'
    (tmp_path / "in" / "audit.log").write_text(text)
    make = lambda s: enrich_execve(parse_audit(read_audit(spark, str(tmp_path / "in"), stream=s))).select(
        "record_type", "epoch_ms", "facility", "line_out"
    )
    R.append_files(make(True), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "o"))) == rows(make(False))


def test_deliveries_have_files_for_their_rows(spark, tmp_path, monkeypatch):
    """Larger deliveries have more files, also where ids repeat, and hold every row in its turn."""
    from logforge.streaming import jobs

    monkeypatch.setattr(jobs, "work_dir", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(jobs, "FILE_ROWS", 20)
    events = [(k // 50 * 50, "click") for k in range(1600)]
    own = spark.createDataFrame(events, "event_id LONG, event_type STRING").selectExpr("event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "event_id % 9 AS user_id", "event_type")
    own.write.parquet(str(tmp_path / "events.parquet"))
    jobs.delivered(spark, str(tmp_path))
    for k in range(4):
        folder = tmp_path / "deliveries" / str(k)
        assert len(list(folder.glob("part-*.parquet"))) == 20
        got = sorted(r.event_id for r in spark.read.parquet(str(folder)).collect())
        assert got == [i for i, _ in events if min(int(i / 388), 3) == k]
