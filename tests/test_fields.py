from pyspark.sql import functions as F

from logforge.functions import audit as A
from logforge.functions.text import strip
from logforge.operators.enrich import extract_fields, parse_shape
from logforge.sources.logs import drop_blank, parse_audit, parse_received, parse_syslog


def column(df, c):
    return [r[0] for r in df.orderBy("at").select(c).collect()]


def test_record_type(spark, texts):
    df = texts("type=EXECVE x", "subj_type=foo type=BAR", "none", "type=a1B", "x type=USER_CMD2")
    assert column(df, A.record_type("msg")) == ["EXECVE", "foo", "", "a1B", "USER_CMD2"]
    assert column(df, A.record_type("msg", "fallback")) == ["EXECVE", "BAR", "UNKNOWN", "UNKNOWN", "USER_CMD"]


def test_result(spark, texts):
    df = texts("res=success", "success=yes", "success=no", "nothing", "xres=success'")
    assert column(df, A.audit_result("msg")) == ["success", "success", "failed", "failed", "success"]


def test_fields_compat_and_strict(spark, texts):
    df = texts("auid=5 uid=7", "ppid=1 pid=2", 'exe="/bin/x" key="k" success=no auid=-1', "nothing")
    compat = extract_fields(df).orderBy("at").collect()
    strict = extract_fields(df, "strict").orderBy("at").collect()
    assert (compat[0]["uid"], strict[0]["uid"]) == ("5", "7")
    assert (compat[1]["pid"], strict[1]["pid"]) == ("1", "2")
    assert (compat[2]["exe"], compat[2]["key"], compat[2]["success"], compat[2]["auid"]) == ("/bin/x", "k", "no", "-1")
    assert tuple(compat[3])[2:] == ("UNKNOWN", "-1", "-1", "-1", "-1", "unknown", "unknown", "none")


def test_header(spark, texts):
    df = parse_audit(texts("audit(1704070000.250:8123):", "audit(123:456)", "audit(1.5:7)", "no", "audit(x:1)"))
    rows = [(r["epoch_ms"], r["serial"]) for r in df.orderBy("at").collect()]
    assert rows == [(1704070000250, 8123), (123000, 456), (1500, 7), (None, None), (None, None)]


def test_unset_ids(spark, texts):
    df = texts("4294967295", "-1", "unset", "0", "1000", "chrony")
    assert column(df, A.is_unset("msg")) == [True, True, True, False, False, True]
    assert column(df, A.auid_is_user("msg")) == [False, False, False, False, True, False]


def test_kv_map_keeps_enriched_names_apart(spark, texts):
    df = texts('type=EXECVE uid=0 a0="x y" uid=5\x1dUID="root" AUID="u"')
    got = df.select(A.kv_map("msg")).first()[0]
    assert got == {"type": "EXECVE", "uid": "0", "a0": "x y", "UID": "root", "AUID": "u"}


def test_shapes(spark, texts):
    df = texts(
        "type=USER_AUTH msg=audit(1.2:3): pid=1 uid=0 auid=4294967295 ses=2 msg='op=PAM:x acct=\"bob\" "
        "exe=\"/bin/s\" hostname=h addr=10.0.0.1 terminal=ssh res=failed'",
        "type=USER_AUTH msg=audit(1.2:3): pid=1 uid=0 auid=1 ses=2 msg='op=x acct=\"bob\" exe=\"/bin/s\" "
        "hostname=h addr=host terminal=ssh res=failed'",
        'type=EXECVE msg=audit(5:6): argc=4 a0="a" a1="" a2="c d" a3="e"',
    )
    auth = [r["shape"] for r in parse_shape(df, "USER_AUTH").orderBy("at").collect()]
    assert auth[0]["acct"] == "bob" and auth[0]["auid"] == 4294967295 and auth[0]["res"] == "failed"
    assert auth[1] is None and auth[2] is None
    execve = [r["shape"] for r in parse_shape(df, "EXECVE").orderBy("at").collect()]
    assert execve[2].asDict() == {
        "type": "EXECVE", "audit_epoch": 5, "audit_counter": 6, "argc": 4, "a0": "a", "a1": "", "a2": "c d", "a3": "e"
    }


def test_syslog_parse(spark):
    rows = [
        "<86>2024-01-02T03:04:05.678+02:00 web1 sshd[42]: Accepted key: yes",
        "<13>Jan  2 03:04:05 web2 CRON[7]: (root) CMD",
        "Feb 12 13:14:15 web3 app/worker: hi",
        "no syslog at all",
        "<30>2024-01-02T03:04:05Z h kernel: a\nb",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "at INT, value STRING")
    got = parse_syslog(df, year=2024).withColumn("ms", F.unix_millis("ts")).orderBy("at").collect()
    assert [r["host"] for r in got] == ["web1", "web2", "web3", None, "h"]
    assert [r["program"] for r in got] == ["sshd", "CRON", "app", None, "kernel"]
    assert [r["pid"] for r in got] == [42, 7, None, None, None]
    assert [r["msg"] for r in got] == ["Accepted key: yes", "(root) CMD", "hi", "no syslog at all", "a\nb"]
    assert [r["facility_text"] for r in got] == ["authpriv", "user", None, None, "daemon"]
    assert [r["severity"] for r in got] == [6, 5, None, None, 6]
    assert got[0]["ms"] == 1704157445678
    assert got[1]["ts"].strftime("%m-%d %H:%M:%S") and got[2]["ts"] is not None and got[3]["ts"] is None


def test_received_parse(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00.5Z h tag: a b  c",)], "value STRING")
    row = parse_received(df).first()
    assert (row["host"], row["tag"], row["msg"]) == ("h", "tag:", "a b  c")


def test_strip_and_blank(spark):
    values = ["  a ", "\x1d b　", " ", "", "c\x1dd"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "at INT, value STRING")
    assert column(df, strip("value")) == [v.strip() for v in values]
    assert [r["value"] for r in drop_blank(df).orderBy("at").collect()] == ["a", "b", "c\x1dd"]
