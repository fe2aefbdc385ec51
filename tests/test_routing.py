from pyspark.sql import functions as F

from logforge.functions import render as R
from logforge.operators import routing as O
from logforge.operators.enrich import dual_format, forwarded_fields, frame_octets, render_json, render_leef
from logforge.sources.lookups import ignored_programs


def syslog(spark, *rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "at INT, program STRING, facility INT, severity INT, msg STRING",
    )


def values(df, c):
    return [r[c] for r in df.orderBy("at").collect()]


def test_route_per_profile(spark):
    df = syslog(
        spark,
        ("sshd", 3, 6, ""),        # noise beats keep
        ("Cron", 1, 6, ""),        # case-sensitive
        ("sshd", 10, 6, ""),
        ("nginx", 1, 6, ""),
        ("httpd", 1, 6, ""),
        ("apache2", 1, 6, ""),
        ("systemd-foo", 4, 6, ""),
        ("audit", 19, 6, ""),
        ("kernel:x", 1, 6, ""),
        (None, None, None, "raw"),
        ("app", 2, 6, ""),
    )
    D, K, N = "DROP", "FORWARD", "DEFAULT"
    assert values(O.route(df, "universal"), "route") == [D, N, K, N, N, N, D, K, N, N, N]
    assert values(O.route(df, "debian"), "route") == [D, N, K, D, N, D, D, K, D, N, D]
    assert values(O.route(df, "rhel"), "route") == [D, N, K, D, D, N, D, K, D, N, D]
    assert values(O.route(df, "manual"), "route") == [N, N, N, N, N, N, N, K, N, N, N]


def test_expected_route_counts(spark):
    from logforge.plans.fleet import fleet_lines

    lines = fleet_lines(spark, "/root/testdata/sf0.01")
    want = {"universal": (625, 8750, 625), "debian": (875, 8750, 375), "rhel": (1000, 8750, 250)}
    for profile, counts in want.items():
        got = {r["route"]: r["count"] for r in O.route(lines, profile).groupBy("route").count().collect()}
        assert (got["DROP"], got["FORWARD"], got["DEFAULT"]) == counts


def test_selectors(spark):
    df = syslog(spark, ("k", 0, 4, ""), ("k", 0, 5, ""), ("a", 10, 0, ""), ("x", 1, 6, ""), ("l", 19, 6, ""))
    got = O.route_selectors(df, local_copy="copy").groupBy("at").agg(F.sort_array(F.collect_list("sink")).alias("s"))
    assert {r["at"]: r["s"] for r in got.collect()} == {
        0: ["kern.log", "syslog"], 1: ["syslog"], 2: ["all-users", "auth.log"], 3: ["syslog"], 4: ["copy", "syslog"],
    }
    only_none = O.route_selectors(df, (("auth,authpriv.none", "x"),))
    assert only_none.count() == 0


def test_lookup_filter(spark):
    df = syslog(spark, ("systemd", 1, 6, ""), ("Systemd", 1, 6, ""), (None, 1, 6, ""), ("cups-browsed", 1, 6, ""))
    lookup = ignored_programs(spark)
    assert lookup.count() == 23
    assert values(O.apply_lookup(df, lookup), "action") == ["IGNORE", "PASS", "PASS", "IGNORE"]
    assert values(O.drop_ignored(df, lookup), "at") == [1, 2]


def test_keywords_and_texts(spark):
    df = syslog(spark, ("a", 1, 1, "login failed"), ("a", 1, 1, "daemon start ok"), ("a", 1, 1, "VIRUS found"), ("a", 1, 1, "ok"))
    assert values(O.keep_keywords(df), "at") == [0, 2]
    assert values(O.drop_text(df), "at") == [0, 2, 3]
    assert values(O.drop_text(df, ("a.c",)), "at") == [0, 1, 2, 3]


def test_exclude_types(spark):
    df = syslog(spark, *[("a", 1, 1, f"type={t}") for t in ("AVC", "CWD", "SYSCALL", "EOE")])
    assert values(O.exclude_types(df), "at") == [2]


def test_split_outputs(spark):
    df = syslog(spark, ("audit", 19, 6, "type=EXECVE x"), ("audit", 19, 6, "type=PATH"), ("cron", 9, 6, "type=EXECVE"))
    raw, tee = O.split_outputs(df)
    assert values(raw, "at") == [0, 1] and values(tee, "at") == [0]


def test_renders(spark):
    df = spark.sql(
        "SELECT timestamp_micros(1704423845006789) AS ts, 'h' AS host, 19 AS facility, 6 AS severity, 'audit' AS program, "
        "'type=PATH exe=\"/a|b\"' AS msg"
    )
    row = df.select(
        R.rfc3339().alias("a"), R.received().alias("b"), R.traditional().alias("c"),
        R.rfc3339_time("ts", session_zone=True).alias("d"), R.traditional_time("ts", session_zone=True).alias("e"),
    ).first()
    assert row["a"] == '<158>2024-01-05T03:04:05.006Z h audit: type=PATH exe="/a|b"'
    assert row["b"] == '2024-01-05T03:04:05.006Z h audit type=PATH exe="/a|b"'
    assert row["c"] == 'Jan  5 03:04:05 h audit: type=PATH exe="/a|b"'
    assert row["d"] == "2024-01-04T22:04:05.006-05:00" and row["e"] == "Jan  4 22:04:05"
    leef = render_leef(forwarded_fields(df)).first()["line_out"]
    assert leef == (
        "LEEF:2.0|Linux|auditd|1.0|PATH|devTime=2024-01-05T03:04:05.006Z\tauid=-1\tuid=-1\teuid=-1\tpid=-1\t"
        "exe=/a\\|b\tsuccess=unknown\tkey=none\tcmd=N/A"
    )
    both = {r["format"]: r["line_out"] for r in dual_format(forwarded_fields(df)).collect()}
    assert both == {"leef": leef, "traditional": row["c"]}
    assert render_json(df, ["host", "severity"]).first()["line_out"] == '{"host":"h","severity":6}'


def test_octet_frame_counts_bytes(spark):
    df = spark.createDataFrame([("aé",)], "line_out STRING")
    assert frame_octets(df).first()["line_out"] == "3 aé"
