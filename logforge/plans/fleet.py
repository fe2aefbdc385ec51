"""Fleet log lines, accounts and rule lines that Spark derives from ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BASE_SECOND = 1704067200
# Microseconds since 1970 of a zoneless time, without going through the session zone.
_MICROS = (
    "unix_date(CAST(ts AS DATE)) * 86400000000L + (hour(ts) * 3600L + minute(ts) * 60L) * 1000000L "
    "+ CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT)"
)

# Per event type: first argument, second argument, audit key.
_COMMANDS = {
    "click": ("sudo", "ls", "T1169_Sudo"),
    "view": ("cat", "/etc/shadow", "T1087_Account_Discovery"),
    "purchase": ("curl", "-o", "T1219_Remote_Access_Tools"),
    "signup": ("useradd", "-m", "T1078_Valid_Accounts"),
    "error": ("systemctl", "stop", "Power_State_Change"),
}
# Plain messages: (program, facility) by event group.
_PLAIN = (
    ("cron", 9), ("systemd-logind", 3), ("nginx", 1), ("httpd", 1), ("CRON", 1),
    ("myapp", 1), ("sshd", 3), ("postfix", 2), ("colord", 1), ("kernel", 0),
)


def _by_type(values: dict[str, Column | str]) -> Column:
    c = F.col("event_type")
    out = None
    for name, value in values.items():
        value = F.lit(value) if isinstance(value, str) else value
        out = F.when(c == name, value) if out is None else out.when(c == name, value)
    return out


def _text(*parts) -> Column:
    """Concatenate: strings are literal text, columns are cast to text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def fleet_lines(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    return derive_lines(spark.read.parquet(f"{sf_dir}/events.parquet"), text)


def derive_lines(events: DataFrame, text: bool = True) -> DataFrame:
    """One log line per event row: eight rows make one audit event and its company.

    Without ``text`` only the columns beside message and line are made.
    """
    e = events.select("event_id", "ts", "user_id", "event_type").withColumns(
        {
            "g": F.expr("event_id div 8"),
            "k": F.col("event_id") % 8,
            "us": F.expr(_MICROS),
        }
    )
    eid, user, g, k = F.col("event_id"), F.col("user_id"), F.col("g"), F.col("k")
    failed = F.col("event_type") == "error"
    e = e.withColumns(
        {
            "a0": _by_type({t: v[0] for t, v in _COMMANDS.items()}),
            "a1": _by_type({t: v[1] for t, v in _COMMANDS.items()}),
            "a2": _by_type(
                {
                    "click": "-la /tmp",
                    "view": "",
                    "purchase": _text("/tmp/f", eid),
                    "signup": _text("user", user),
                    "error": "auditd",
                }
            ),
            "key": _by_type({t: v[2] for t, v in _COMMANDS.items()}),
            "severity": F.when(failed, 3)
            .when(F.col("event_type") == "purchase", 4)
            .otherwise(6),
            "host": _text("host", g % 16),
            "hdr": _text(
                "audit(", g + _BASE_SECOND, ".", F.lpad((g % 1000).cast("string"), 3, "0"), ":",
                g * 10 + F.when(k <= 2, 0).when(k <= 4, 1).when(k == 5, 2).otherwise(3), "):",
            ),
            "login": F.when(user % 7 == 0, F.lit("4294967295")).otherwise(
                (user % 7 + 1000).cast("string")
            ),
            "ids": _text(
                "auid=",
                F.when(user % 7 == 0, F.lit("4294967295")).otherwise(
                    (user % 7 + 1000).cast("string")
                ),
                " uid=", F.when(user % 5 == 0, F.lit(0)).otherwise(user % 5 + 1000),
                " gid=", user % 3,
            ),
        }
    )
    hdr, ids, a0, a1, a2 = (F.col(c) for c in ("hdr", "ids", "a0", "a1", "a2"))
    syscall = _text(
        "type=SYSCALL msg=", hdr, " arch=c000003e syscall=59",
        F.when(failed, " success=no exit=-13").otherwise(" success=yes exit=0"),
        " a0=55d0 a1=55d1 a2=55d2 a3=8 items=2 ppid=", user + 100, " pid=", eid + 2000, " ",
        ids, " euid=0 suid=0 fsuid=0 egid=0 sgid=0 fsgid=0 tty=pts0 ses=", user,
        ' comm="', a0, '" exe="/usr/bin/', a0, '" key="', F.col("key"), '"',
    )
    execve = _text(
        "type=EXECVE msg=", hdr, " ",
        F.when(g % 2 == 0, F.concat(ids, F.lit(" "))).otherwise(""),
        'argc=3 a0="', a0, '" a1="', a1, '" a2=',
        F.when((g % 3 == 0) & (a2 != ""), F.hex(a2)).otherwise(_text('"', a2, '"')),
        F.when(g % 5 == 0, ' a10="tail"').otherwise(""),
    )
    path = _text(
        "type=PATH msg=", hdr, ' item=0 name="',
        F.when(F.col("event_type") == "view", "/etc/shadow").otherwise(_text("/usr/bin/", a0)),
        '" nametype=NORMAL',
    )
    auth = _text(
        "type=USER_AUTH msg=", hdr, " pid=", eid + 2000, " uid=0 auid=", user % 7 + 1000,
        " ses=", user, " msg='op=PAM:authentication acct=\"user", user,
        '" exe="/usr/sbin/sshd" hostname=h addr=10.0.0.', user, " terminal=ssh res=",
        F.when(failed, "failed").otherwise("success"), "'",
    )
    sudo = _text(
        "type=USER_CMD msg=", hdr, " pid=", eid + 2000, " uid=1000 auid=", user % 7 + 1000,
        " ses=", user, " msg='cwd=\"/home/user", user, '" cmd=',
        F.hex(F.concat_ws(" ", a0, a1)), " terminal=pts/0 res=success'",
    )
    plain = F.when(failed, "error: access denied").otherwise(
        _text(F.col("event_type"), " message")
    )
    by_group = lambda i: F.get(F.array(*[F.lit(p[i]) for p in _PLAIN]), (g % 10).cast("int"))
    e = e.withColumns(
        {
            "msg": F.when(k.isin(0, 3), syscall)
            .when(k.isin(1, 4), execve)
            .when(k == 2, path)
            .when(k == 5, auth)
            .when(k == 6, sudo)
            .otherwise(plain),
            "program": F.when(k <= 4, "audit").when(k == 5, "sshd").when(k == 6, "sudo")
            .otherwise(by_group(0)),
            "facility": F.when(k <= 4, 19).when(k <= 6, 10).otherwise(by_group(1)),
        }
    )
    columns = [
        "event_id", "us", "user_id", "event_type", "host", "facility", "severity", "program",
    ]
    if not text:
        return e.select(*columns)
    # As if scanned: the explode keeps later filters from repeating the text building.
    e = e.withColumn("msg", F.explode(F.array("msg")))
    stamp, millis = F.col("ts").cast("string"), F.expr("us div 1000 % 1000").cast("string")
    return e.withColumn(
        "line",
        _text(
            "<", F.col("facility") * 8 + F.col("severity"), ">",
            F.substring(stamp, 1, 10), "T", F.substring(stamp, 12, 8), ".",
            F.lpad(millis, 3, "0"), "Z ", F.col("host"), " ", F.col("program"), ": ", F.col("msg"),
        ),
    ).select(*columns, "msg", "line")


def accounts(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """passwd and groups (host, id, name) of the hosts in the lines.

    Login ids come from the users seen; 1003 is left out, so unknown ids occur.
    """
    seen = lines.select("host", "user_id")
    ids = F.array(F.lit(0), F.col("user_id") % 7 + 1000, F.col("user_id") % 5 + 1000)
    passwd = (
        seen.select("host", F.explode(ids).alias("id"))
        .filter(F.col("id") != 1003)
        .distinct()
        .withColumn(
            "name",
            F.when(F.col("id") == 0, "root").otherwise(F.concat(F.lit("user"), F.col("id"))),
        )
    )
    groups = (
        seen.select("host", (F.col("user_id") % 3).alias("id"))
        .filter(F.col("id") < 2)
        .distinct()
        .withColumn("name", F.when(F.col("id") == 0, "root").otherwise(F.lit("daemon")))
    )
    return passwd, groups


def derive_rule_lines(events: DataFrame) -> DataFrame:
    """Rule listing per host: one line of rule-file text per event row."""
    user, eid = F.col("user_id"), F.col("event_id")
    kind = eid % 8
    arch = F.when(eid % 2 == 0, "b64").otherwise("b32")
    text = (
        F.when(kind == 0, _text("-w /home/user", user, "/.ssh/ -p wa -k T1021_keys_", user % 9))
        .when(
            kind == 1,
            _text("-a always,exit -F arch=", arch, " -S open,openat -S creat -F dir=/data/",
                  user, " -F success=0 -F auid>=1000 -F auid!=unset -k T1068_", F.col("event_type")),
        )
        .when(kind == 2, _text("## listing of user ", user))
        .when(kind == 3, _text("-w /opt/app", user, "/run.sh -k app_", F.col("event_type")))
        .when(kind == 4, _text("-a exit,never -F arch=", arch, " -F dir=/scratch/", user, " -k scratch"))
        .when(kind == 5, _text("-a always,exclude -F msgtype=T", user))
        .when(kind == 6, _text("-b ", user + 8192))
        .otherwise("")
    )
    return events.select(
        "event_id", "ts", _text("host", F.expr("event_id div 8") % 16).alias("ruleset"),
        eid.alias("idx"), text.alias("value"),
    )
