"""DuckDB twins of the registered queries, on the same Parquet tables.

Written relationally (unnest, joins, string_agg) where the Spark side works on
arrays inside one row, so the two do not share an approach.
"""

from __future__ import annotations

import re

from logforge.facts import (
    FACILITIES,
    IGNORED_PROGRAMS,
    KEEP_PROFILES,
    NOISE_PROFILES,
    SECURITY_KEYWORDS,
    SEVERITIES,
    TECHNIQUES,
    UNWANTED_PROGRAMS,
)
from logforge.rulesets import RULESETS, rule_rows


def _q(text) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(_q(v) for v in values)})" if values else "FALSE"


def _pick(values: dict) -> str:
    return "CASE event_type " + " ".join(f"WHEN {_q(k)} THEN {v}" for k, v in values.items()) + " END"


_A0 = {"click": "'sudo'", "view": "'cat'", "purchase": "'curl'", "signup": "'useradd'", "error": "'systemctl'"}
_A1 = {"click": "'ls'", "view": "'/etc/shadow'", "purchase": "'-o'", "signup": "'-m'", "error": "'stop'"}
_A2 = {"click": "'-la /tmp'", "view": "''", "purchase": "'/tmp/f' || event_id", "signup": "'user' || user_id", "error": "'auditd'"}
_KEY = {
    "click": "'T1169_Sudo'", "view": "'T1087_Account_Discovery'", "purchase": "'T1219_Remote_Access_Tools'",
    "signup": "'T1078_Valid_Accounts'", "error": "'Power_State_Change'",
}

LINES = f"""
base AS (
  SELECT event_id, ts, epoch_us(ts) AS us, user_id, event_type,
         event_id // 8 AS g, event_id % 8 AS k FROM events),
cmds AS (
  SELECT *, {_pick(_A0)} AS a0, {_pick(_A1)} AS a1, {_pick(_A2)} AS a2, {_pick(_KEY)} AS ckey,
    CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 4 ELSE 6 END AS severity,
    'host' || (g % 16) AS host,
    'audit(' || (1704067200 + g) || '.' || lpad(CAST(g % 1000 AS VARCHAR), 3, '0') || ':' ||
      (10 * g + CASE WHEN k <= 2 THEN 0 WHEN k <= 4 THEN 1 WHEN k = 5 THEN 2 ELSE 3 END) || '):' AS hdr,
    'auid=' || (CASE WHEN user_id % 7 = 0 THEN 4294967295 ELSE 1000 + user_id % 7 END) ||
      ' uid=' || (CASE WHEN user_id % 5 = 0 THEN 0 ELSE 1000 + user_id % 5 END) ||
      ' gid=' || (user_id % 3) AS ids
  FROM base),
msgs AS (
  SELECT *, CASE
    WHEN k IN (0, 3) THEN 'type=SYSCALL msg=' || hdr || ' arch=c000003e syscall=59' ||
      (CASE WHEN event_type = 'error' THEN ' success=no exit=-13' ELSE ' success=yes exit=0' END) ||
      ' a0=55d0 a1=55d1 a2=55d2 a3=8 items=2 ppid=' || (100 + user_id) || ' pid=' || (2000 + event_id) ||
      ' ' || ids || ' euid=0 suid=0 fsuid=0 egid=0 sgid=0 fsgid=0 tty=pts0 ses=' || user_id ||
      ' comm="' || a0 || '" exe="/usr/bin/' || a0 || '" key="' || ckey || '"'
    WHEN k IN (1, 4) THEN 'type=EXECVE msg=' || hdr || ' ' || (CASE WHEN g % 2 = 0 THEN ids || ' ' ELSE '' END) ||
      'argc=3 a0="' || a0 || '" a1="' || a1 || '" a2=' ||
      (CASE WHEN g % 3 = 0 AND a2 <> '' THEN hex(a2) ELSE '"' || a2 || '"' END) ||
      (CASE WHEN g % 5 = 0 THEN ' a10="tail"' ELSE '' END)
    WHEN k = 2 THEN 'type=PATH msg=' || hdr || ' item=0 name="' ||
      (CASE WHEN event_type = 'view' THEN '/etc/shadow' ELSE '/usr/bin/' || a0 END) || '" nametype=NORMAL'
    WHEN k = 5 THEN 'type=USER_AUTH msg=' || hdr || ' pid=' || (2000 + event_id) || ' uid=0 auid=' ||
      (1000 + user_id % 7) || ' ses=' || user_id || ' msg=''op=PAM:authentication acct="user' || user_id ||
      '" exe="/usr/sbin/sshd" hostname=h addr=10.0.0.' || user_id || ' terminal=ssh res=' ||
      (CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END) || ''''
    WHEN k = 6 THEN 'type=USER_CMD msg=' || hdr || ' pid=' || (2000 + event_id) || ' uid=1000 auid=' ||
      (1000 + user_id % 7) || ' ses=' || user_id || ' msg=''cwd="/home/user' || user_id || '" cmd=' ||
      hex(a0 || ' ' || a1) || ' terminal=pts/0 res=success'''
    ELSE CASE WHEN event_type = 'error' THEN 'error: access denied' ELSE event_type || ' message' END
    END AS msg,
    CASE WHEN k <= 4 THEN 'audit' WHEN k = 5 THEN 'sshd' WHEN k = 6 THEN 'sudo'
      ELSE (['cron', 'systemd-logind', 'nginx', 'httpd', 'CRON', 'myapp', 'sshd', 'postfix', 'colord', 'kernel'])[g % 10 + 1]
      END AS program,
    CASE WHEN k <= 4 THEN 19 WHEN k <= 6 THEN 10 ELSE ([9, 3, 1, 1, 1, 1, 3, 2, 1, 0])[g % 10 + 1] END AS facility
  FROM cmds),
lines AS (
  SELECT event_id, ts, us, g, k, user_id, event_type, host, facility, severity, program, msg,
    '<' || (facility * 8 + severity) || '>' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z ' || host || ' ' ||
      program || ': ' || msg AS line
  FROM msgs)"""

ARGS = r"""
ex AS (SELECT * FROM lines WHERE contains(msg, 'type=EXECVE')),
quoted AS (
  SELECT event_id, CAST(i AS BIGINT) AS idx, arg_max(v, p) AS val FROM (
    SELECT event_id, unnest(regexp_extract_all(msg, 'a(\d+)="([^"]*)"', 1)) AS i,
      unnest(regexp_extract_all(msg, 'a(\d+)="([^"]*)"', 2)) AS v,
      unnest(range(len(regexp_extract_all(msg, 'a(\d+)="([^"]*)"', 1)))) AS p FROM ex)
  GROUP BY event_id, CAST(i AS BIGINT)),
hexed AS (
  SELECT event_id, CAST(i AS BIGINT) AS idx, arg_min(v, p) AS val FROM (
    SELECT event_id, unnest(regexp_extract_all(msg, 'a(\d+)=([0-9A-Fa-f]+)', 1)) AS i,
      unnest(regexp_extract_all(msg, 'a(\d+)=([0-9A-Fa-f]+)', 2)) AS v,
      unnest(range(len(regexp_extract_all(msg, 'a(\d+)=([0-9A-Fa-f]+)', 1)))) AS p FROM ex)
  WHERE length(v) % 2 = 0 GROUP BY event_id, CAST(i AS BIGINT)),
args AS (
  SELECT event_id, idx, val FROM quoted
  UNION ALL
  SELECT h.event_id, h.idx, decode(unhex(h.val)) FROM hexed h
  WHERE NOT EXISTS (SELECT 1 FROM quoted q WHERE q.event_id = h.event_id AND q.idx = h.idx)),
commands AS (
  SELECT event_id, string_agg(val, ' ' ORDER BY idx) AS cmd FROM args GROUP BY event_id)"""

_CLEAN = r"""trim(regexp_replace(regexp_replace(regexp_replace(msg, 'a\d+="[^"]*"', '', 'g'),
  'a\d+=[0-9A-Fa-f]+', '', 'g'), 'argc=\d+\s*', '', 'g'))"""


def _tags(column: str) -> str:
    """List of (technique, hit) tests as SQL."""
    tests = []
    for technique, patterns in TECHNIQUES.items():
        hit = " OR ".join(f"contains({column}, {_q(p)})" for p in patterns)
        tests.append(f"CASE WHEN {hit} THEN {_q(technique)} END")
    return f"list_sort(list_filter([{', '.join(tests)}], lambda x: x IS NOT NULL))"


def _strict_tags(column: str) -> str:
    tests = []
    for technique, patterns in TECHNIQUES.items():
        words = "|".join(p.replace(".", r"\.") for p in patterns)
        tests.append(
            rf"CASE WHEN regexp_matches({column}, '(?:^|[^\w.-])(?:{words})[0-9.]*(?:$|[^\w-])') THEN {_q(technique)} END"
        )
    return f"list_filter([{', '.join(tests)}], lambda x: x IS NOT NULL)"


TAGS = f"""
tagged AS (
  SELECT l.event_id, l.us, l.host, l.user_id, c.cmd, {_tags('c.cmd')} AS tags
  FROM commands c JOIN lines l USING (event_id))"""

NAMES = r"""
passwd AS (
  SELECT DISTINCT host, id, CASE WHEN id = 0 THEN 'root' ELSE 'user' || id END AS name FROM (
    SELECT host, unnest([0, user_id % 7 + 1000, user_id % 5 + 1000]) AS id FROM lines) WHERE id <> 1003),
grp AS (
  SELECT DISTINCT host, user_id % 3 AS id, CASE WHEN user_id % 3 = 0 THEN 'root' ELSE 'daemon' END AS name
  FROM lines WHERE user_id % 3 < 2)"""

ENRICHED = rf"""
cleaned AS (
  SELECT e.event_id, e.host, c.cmd, {_CLEAN} AS line_clean FROM ex e JOIN commands c USING (event_id)),
ided AS (
  SELECT *, CASE WHEN a <> '4294967295' THEN TRY_CAST(a AS BIGINT) END AS auid_id,
    CASE WHEN u <> '4294967295' THEN TRY_CAST(u AS BIGINT) END AS uid_id,
    CASE WHEN g <> '4294967295' THEN TRY_CAST(g AS BIGINT) END AS gid_id FROM (
    SELECT *, regexp_extract(line_clean, '\bauid=(\d+)', 1) AS a, regexp_extract(line_clean, '\buid=(\d+)', 1) AS u,
      regexp_extract(line_clean, '\bgid=(\d+)', 1) AS g FROM cleaned)),
named AS (
  SELECT i.event_id, i.cmd, i.line_clean, i.auid_id, i.uid_id, i.gid_id, p1.name AS auid_name, p2.name AS uid_name,
    p3.name AS gid_name, array_to_string({_tags('i.cmd')}, ',') AS tags
  FROM ided i LEFT JOIN passwd p1 ON p1.host = i.host AND p1.id = i.auid_id
  LEFT JOIN passwd p2 ON p2.host = i.host AND p2.id = i.uid_id
  LEFT JOIN grp p3 ON p3.host = i.host AND p3.id = i.gid_id),
outs AS (
  SELECT *, line_clean || ' cmd="' || cmd || '"' ||
    coalesce(' auid_name="' || auid_name || '"', '') || coalesce(' uid_name="' || uid_name || '"', '') ||
    coalesce(' gid_name="' || gid_name || '"', '') ||
    CASE WHEN tags <> '' THEN ' mitre_techniques="' || tags || '"' ELSE '' END AS line_out
  FROM named)"""

_FACILITY = "([" + ", ".join(_q(f) for f in FACILITIES) + "])[facility + 1]"
_SEVERITY = "([" + ", ".join(_q(s) for s in SEVERITIES) + "])[severity + 1]"


def _noise(profile: str) -> str:
    sets = NOISE_PROFILES[profile]
    tests = [_in("program", sets["name"]), _in(_FACILITY, sets["facility"])]
    tests += [f"starts_with(program, {_q(p)})" for p in sets["prefix"]]
    return "(" + " OR ".join(tests) + ")"


def _keep(profile: str) -> str:
    sets = KEEP_PROFILES[profile]
    return f"({_in('program', sets['name'])} OR {_in(_FACILITY, sets['facility'])})"


def _routed(profile: str) -> str:
    return f"CASE WHEN {_noise(profile)} THEN 'DROP' WHEN {_keep(profile)} THEN 'FORWARD' ELSE 'DEFAULT' END"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _first(pattern: str, default: str, column: str = "msg") -> str:
    return f"coalesce(nullif(regexp_extract({column}, {_q(pattern)}, 1), ''), {_q(default)})"


def _value(name: str, column: str = "msg") -> str:
    return f"""nullif(regexp_extract({column}, '\\b{name}="?([^"\\s]+)', 1), '')"""


_FIELD_SQL = (
    ("auid", "auid=([0-9-]+)", "-1"), ("uid", "uid=([0-9]+)", "-1"), ("euid", "euid=([0-9]+)", "-1"),
    ("pid", "pid=([0-9]+)", "-1"), ("exe", 'exe="([^"]+)"', "unknown"),
    ("success", "success=([a-z]+)", "unknown"), ("key", 'key="([^"]+)"', "none"),
)


def _fields(edge: str = "") -> str:
    cells = [_first("type=([A-Z_]+)", "UNKNOWN") + " AS audit_type"]
    cells += [f"{_first(edge + p, d)} AS {n}" for n, p, d in _FIELD_SQL]
    return ", ".join(cells)


_RESULT = "CASE WHEN contains(msg, 'res=success') OR contains(msg, 'success=yes') THEN 'success' ELSE 'failed' END"
_TYPE = r"regexp_extract(msg, 'type=(\w+)', 1)"
_FALLBACK = (
    "CASE WHEN contains(msg, 'type=EXECVE') THEN regexp_extract(msg, 'a0=\"([^\"]+)\"', 1) || "
    + " || ".join(
        f"CASE WHEN regexp_extract(msg, 'a{i}=\"([^\"]+)\"', 1) <> '' THEN ' ' || "
        f"regexp_extract(msg, 'a{i}=\"([^\"]+)\"', 1) ELSE '' END"
        for i in range(1, 10)
    )
    + " ELSE 'N/A' END"
)

RECORDS = rf"""
records AS (
  SELECT *, {_TYPE} AS record_type,
    TRY_CAST(regexp_extract(msg, 'audit\((\d+)\.(\d+):(\d+)\)', 1) AS BIGINT) * 1000 +
      TRY_CAST(regexp_extract(msg, 'audit\((\d+)\.(\d+):(\d+)\)', 2) AS BIGINT) AS epoch_ms,
    TRY_CAST(regexp_extract(msg, 'audit\((\d+)\.(\d+):(\d+)\)', 3) AS BIGINT) AS serial
  FROM lines)"""


def _only_group(pattern: str, wanted: int) -> str:
    """The pattern with one capturing group left (SQL extracts at most nine)."""
    seen = 0

    def keep(match: re.Match) -> str:
        nonlocal seen
        seen += 1
        return "(" if seen == wanted else "(?:"

    return re.sub(r"(?<!\\)\((?!\?)", keep, pattern)


def _shape(fields: str, text: str = "msg", body: str = "") -> str:
    """Groups of one whole-line pattern by position, cast by kind (n number, w text)."""
    pattern = r"^type=(\S+) msg=audit\((\d+)(?:\.\d+)?:(\d+)\): " + body
    cells = []
    for i, f in enumerate(fields.split(), start=1):
        name, kind = f.split(":")
        group = f"regexp_extract({text}, {_q(_only_group(pattern, i))}, 1)"
        cells.append((f"CAST({group} AS BIGINT)" if kind == "n" else group) + f" AS {name}")
    return (
        _with(LINES)
        + f"SELECT event_id, {', '.join(cells)} FROM lines WHERE regexp_matches({text}, {_q(pattern)})"
    )


_HEAD = "type:w audit_epoch:n audit_counter:n "
_MID = r"pid=(\d+) uid=(\d+) auid=(\d+) ses=(\d+) msg='"


def _leef(escape: bool = True) -> str:
    esc = lambda c: (
        rf"replace(replace(replace(replace({c}, '\', '\\'), chr(9), '\t'), chr(10), '\n'), '|', '\|')"
    )
    pairs = [
        f"'{n}=' || {esc(n)}" for n in ("auid", "uid", "euid", "pid", "exe", "success", "key", "cmd")
    ]
    stamp = "'devTime=' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
    return "'LEEF:2.0|Linux|auditd|1.0|' || audit_type || '|' || " + " || chr(9) || ".join([stamp] + pairs)


_TRADITIONAL = (
    "left(monthname(ts), 3) || ' ' || lpad(CAST(day(ts) AS VARCHAR), 2, ' ') || ' ' || "
    "strftime(ts, '%H:%M:%S') || ' ' || host || ' ' || program || ': ' || msg"
)
FIELDED = f"fielded AS (SELECT *, {_fields()}, {_FALLBACK} AS cmd FROM lines)"

EVENTS = rf"""
assembled AS (
  SELECT r.host, r.epoch_ms, r.serial, count(*) AS n_records, max(c.cmd) AS cmd,
    min(CASE WHEN record_type = 'PATH' AND contains(msg, ' item=0 ') THEN {_value('name')} END) AS path,
    max(CASE WHEN record_type = 'SYSCALL' AND regexp_extract(msg, '\bauid=(\d+)', 1) <> '4294967295'
      THEN CAST(regexp_extract(msg, '\bauid=(\d+)', 1) AS BIGINT) END) AS auid_id,
    {', '.join(f"max(CASE WHEN record_type = 'SYSCALL' THEN CAST(regexp_extract(msg, '{chr(92)}b{n}=({chr(92)}d+)', 1) AS BIGINT) END) AS {n}_id" for n in ('uid', 'gid', 'euid'))},
    {', '.join(f"max(CASE WHEN record_type = 'SYSCALL' THEN {_value(n)} END) AS {n}" for n in ('arch', 'syscall', 'exit', 'a0', 'comm', 'exe', 'success'))},
    max({_value('key')}) AS "key", max(CASE WHEN contains(msg, 'success=yes') OR contains(msg, 'res=success') THEN 0
      WHEN contains(msg, 'success=no') OR contains(msg, 'res=failed') THEN 1 END) AS failed
  FROM records r LEFT JOIN commands c USING (event_id) WHERE r.epoch_ms IS NOT NULL
  GROUP BY r.host, r.epoch_ms, r.serial)"""


def _runs(source: str, keys: str, order: str, message: str) -> str:
    """Gaps and islands with window functions over the whole key."""
    return f"""
marked AS (SELECT *, CASE WHEN {message} IS DISTINCT FROM lag({message}) OVER w OR row_number() OVER w = 1
    THEN 1 ELSE 0 END AS new FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY {order})),
islands AS (SELECT *, sum(new) OVER (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS run FROM marked)"""


REPEATS = (
    _with(LINES, _runs("lines", "host, program", "us, event_id", "msg"))
    + """SELECT host, program, any_value(msg) AS msg, count(*) AS repeats, min(us) AS first_us,
  arg_min(event_id, (us, event_id)) AS first_event_id, max(us) AS last_us,
  arg_max(event_id, (us, event_id)) AS last_event_id FROM islands GROUP BY host, program, run"""
)

RULE_LINES = r"""
rule_lines AS (
  SELECT event_id, ts, 'host' || (event_id // 8 % 16) AS ruleset, event_id AS idx, event_id % 8 AS kind_no, user_id,
    event_type, CASE WHEN event_id % 2 = 0 THEN 'b64' ELSE 'b32' END AS arch FROM events),
rule_rows AS (
  SELECT ts, ruleset, CAST(idx AS INTEGER) AS idx,
    CASE WHEN kind_no IN (0, 3) THEN 'watch' WHEN kind_no = 6 THEN 'control' ELSE 'syscall' END AS kind,
    CASE kind_no WHEN 5 THEN 'exclude' WHEN 6 THEN NULL ELSE 'exit' END AS list,
    CASE kind_no WHEN 4 THEN 'never' WHEN 6 THEN NULL ELSE 'always' END AS action,
    CASE kind_no WHEN 0 THEN '/home/user' || user_id || '/.ssh' WHEN 3 THEN '/opt/app' || user_id || '/run.sh' END AS path,
    CASE kind_no WHEN 0 THEN TRUE WHEN 3 THEN FALSE END AS is_dir,
    CASE kind_no WHEN 0 THEN 'wa' WHEN 3 THEN 'rwxa' END AS perm,
    CASE WHEN kind_no = 1 THEN 'open,openat,creat' ELSE '' END AS syscalls,
    CASE kind_no WHEN 1 THEN 'arch=' || arch || ' dir=/data/' || user_id || ' success=0 auid>=1000 auid!=unset'
      WHEN 4 THEN 'arch=' || arch || ' dir=/scratch/' || user_id WHEN 5 THEN 'msgtype=T' || user_id ELSE '' END AS fields,
    CASE kind_no WHEN 0 THEN 'T1021_keys_' || (user_id % 9) WHEN 1 THEN 'T1068_' || event_type
      WHEN 3 THEN 'app_' || event_type WHEN 4 THEN 'scratch' END AS key,
    CASE kind_no WHEN 0 THEN 'T1021' WHEN 1 THEN 'T1068' END AS technique
  FROM rule_lines WHERE kind_no NOT IN (2, 7))"""

_SIGNATURE = """kind || '|' || coalesce(list, '') || '|' || coalesce(action, '') || '|' || coalesce(path, '') || '|' ||
  coalesce(CAST(is_dir AS VARCHAR), '') || '|' ||
  CASE perm WHEN 'wa' THEN 'aw' WHEN 'rwxa' THEN 'arwx' ELSE '' END || '|' ||
  CASE WHEN syscalls = '' THEN '' ELSE 'creat,open,openat' END || '|' ||
  array_to_string(list_sort(string_split(replace(fields, ' ', ','), ',')), ',') || '|' || coalesce(key, '')"""


def _rules_values() -> str:
    """All shipped rule sets as rows, field tests as a list of (name, op, value)."""
    rows = []
    for name in RULESETS:
        for ruleset, idx, kind, to_list, action, path, is_dir, perm, calls, fields, key in rule_rows(name):
            tests = ", ".join(f"{{'n': {_q(n)}, 'o': {_q(o)}, 'v': {_q(v)}}}" for n, o, v in fields)
            null = lambda v: "NULL" if v is None else _q(v)
            rows.append(
                f"({_q(ruleset)}, {idx}, {_q(kind)}, {_q(to_list)}, {_q(action)}, {null(path)}, "
                f"{'NULL' if is_dir is None else str(is_dir).upper()}, {null(perm)}, "
                f"CAST([{', '.join(_q(c) for c in calls)}] AS VARCHAR[]), "
                f"CAST([{tests}] AS STRUCT(n VARCHAR, o VARCHAR, v VARCHAR)[]), {null(key)})"
            )
    return (
        "rules AS (SELECT * FROM (VALUES\n" + ",\n".join(rows)
        + "\n) t(ruleset, idx, kind, list, action, path, is_dir, perm, calls, tests, key))"
    )


# The derived events are all 64-bit execve calls; ids, exit and path vary.
RULE_EVENTS = rf"""
calls AS (
  SELECT host, epoch_ms, serial, 'b64' AS arch, 'execve' AS syscall,
    CAST(CASE WHEN contains(msg, 'success=yes') THEN 1 ELSE 0 END AS BIGINT) AS success,
    CAST({_value('exit')} AS BIGINT) AS exit,
    CASE WHEN {_value('auid')} <> '4294967295' THEN CAST({_value('auid')} AS BIGINT) END AS auid,
    CAST({_value('uid')} AS BIGINT) AS uid, CAST({_value('gid')} AS BIGINT) AS gid,
    CAST({_value('euid')} AS BIGINT) AS euid, CAST(21968 AS BIGINT) AS a0
  FROM records WHERE record_type = 'SYSCALL'),
paths AS (SELECT DISTINCT host, epoch_ms, serial, {_value('name')} AS path FROM records WHERE record_type = 'PATH'),
rule_events AS (SELECT c.*, p.path FROM calls c LEFT JOIN paths p USING (host, epoch_ms, serial))"""

_TEST = """CASE
  WHEN f.n = 'arch' THEN e.arch = f.v
  WHEN f.n IN ('dir', 'path') THEN e.path IS NOT NULL AND
    (e.path = f.v OR (f.n = 'dir' AND starts_with(e.path, f.v || '/')))
  WHEN f.n = 'perm' THEN contains(f.v, 'x')
  WHEN f.n = 'auid' THEN CASE
    WHEN f.o = '!=' THEN e.auid IS NOT NULL
    WHEN f.o = '>=' THEN e.auid IS NOT NULL AND e.auid >= TRY_CAST(f.v AS BIGINT)
    ELSE e.auid IS NULL END
  WHEN f.n = 'uid' THEN coalesce(e.uid = CASE WHEN f.v = 'root' THEN 0 ELSE TRY_CAST(f.v AS BIGINT) END, FALSE)
  WHEN f.n = 'a0' THEN e.a0 = 16
  WHEN f.n = 'success' THEN e.success = CAST(f.v AS BIGINT)
  WHEN f.n = 'exit' THEN e.exit = CAST(f.v AS BIGINT)
  ELSE FALSE END"""

MATCHES = f"""
matches AS (
  SELECT e.host, e.epoch_ms, e.serial, e.path, r.ruleset, r.idx, r.kind, r.action, r.key
  FROM rule_events e JOIN rules r ON r.list = 'exit' AND CASE
    WHEN r.kind = 'watch' THEN contains(r.perm, 'x') AND e.path IS NOT NULL AND
      (e.path = r.path OR starts_with(e.path, r.path || '/'))
    ELSE (len(r.calls) = 0 OR list_contains(r.calls, e.syscall)) AND
      len(list_filter(r.tests, lambda f: NOT ({_TEST}))) = 0 END),
deciding AS (
  SELECT host, epoch_ms, serial, ruleset, arg_min(action, idx) AS action, arg_min(coalesce(key, ''), idx) AS key,
    min(idx) AS idx FROM matches GROUP BY host, epoch_ms, serial, ruleset)"""

_RULED = (RECORDS, RULE_EVENTS, _rules_values(), MATCHES)
ORACLE: dict[str, str] = {}


def _add(name: str, *ctes: str, sql: str) -> None:
    ORACLE[name] = (_with(*ctes) if ctes else "") + sql


_add("execve_command", LINES, ARGS, sql="SELECT e.event_id, c.cmd FROM ex e LEFT JOIN commands c USING (event_id)")
ORACLE["execve_command_strict"] = ORACLE["execve_command"]
_add("execve_argument_rows", LINES, ARGS, sql="""SELECT event_id,
  CAST(row_number() OVER (PARTITION BY event_id ORDER BY idx) - 1 AS INTEGER) AS position, val AS value FROM args""")
_add("execve_clean_line", LINES, ARGS, sql=f"SELECT event_id, {_CLEAN} AS line_clean FROM ex")
_add("execve_historic_line", LINES, ARGS, sql=r"""SELECT l.event_id, CASE WHEN c.cmd IS NULL THEN l.msg ELSE
  'PROCESSED: ' || trim(regexp_replace(l.msg, 'a\d+="[^"]*"\s*', '', 'g')) || ' cmd="' || c.cmd || '"' END AS line_out
  FROM lines l LEFT JOIN commands c USING (event_id)""")
_add("execve_hex_decode", sql="SELECT doc_id, md5('echo ' || text) AS cmd_md5 FROM documents")
_add("execve_enriched_line", LINES, ARGS, NAMES, ENRICHED, sql="SELECT event_id, line_out FROM outs")
_add("execve_passthrough", LINES, ARGS, sql=f"""SELECT l.event_id, coalesce(t.line_out, l.msg) AS line_out,
  t.line_out IS NULL AS same FROM lines l LEFT JOIN (
    SELECT event_id, {_CLEAN} || ' cmd="' || cmd || '"' ||
      CASE WHEN len({_tags('cmd')}) > 0 THEN ' mitre_techniques="' || array_to_string({_tags('cmd')}, ',') || '"' ELSE '' END
      AS line_out FROM ex JOIN commands USING (event_id)) t USING (event_id)""")
_add("execve_manual_profile", LINES, sql=r"""SELECT event_id, CASE WHEN contains(msg, 'type=EXECVE') THEN
  trim(regexp_replace(trim(regexp_replace(msg, 'a\d+="[^"]*"\s*', '', 'g')), 'argc=\d+\s*', '', 'g')) || ' cmd="' ||
  array_to_string(regexp_extract_all(msg, 'a(\d+)="([^"]*)"', 2), ' ') || '"' ELSE msg END AS line_out FROM lines""")
_add("proctitle_drop", LINES, sql="SELECT event_id FROM lines WHERE NOT (k IN (1, 4) AND g % 2 = 0)")
_add("execve_fallback_command", LINES, sql=f"SELECT event_id, {_FALLBACK} AS cmd FROM lines")
_add("identity_names", LINES, ARGS, NAMES, ENRICHED, sql="""SELECT event_id, auid_id, uid_id, gid_id, auid_name,
  uid_name, gid_name FROM named""")
_add("technique_tags", LINES, ARGS, TAGS, sql="""SELECT event_id, nullif(array_to_string(tags, ','), '') AS techniques
  FROM tagged""")
_EXPLODED = "SELECT *, unnest(tags) AS technique FROM tagged"
_add("technique_counts", LINES, ARGS, TAGS, sql=f"""SELECT technique, count(*) AS n_lines,
  count(DISTINCT user_id) AS n_users FROM ({_EXPLODED}) GROUP BY technique""")
_add("technique_counts_strict", LINES, ARGS, sql=f"""SELECT technique, count(*) AS n_lines FROM (
  SELECT unnest({_strict_tags('cmd')}) AS technique FROM commands) GROUP BY technique""")
_add("technique_daily", LINES, ARGS, TAGS, sql=f"""SELECT us // 86400000000 AS day, host, technique, count(*) AS n_lines
  FROM ({_EXPLODED}) GROUP BY 1, 2, 3""")
_add("technique_users", LINES, ARGS, TAGS, sql=f"""SELECT technique, count(DISTINCT user_id) AS n_users, TRUE AS close
  FROM ({_EXPLODED}) GROUP BY technique""")
_add("technique_dictionary", LINES, ARGS, """dictionary AS (
  SELECT DISTINCT 'user' || user_id AS pattern, 'T' || (user_id % 50) AS technique FROM events
  UNION SELECT '/f' || event_id, 'F' || (event_id % 20) FROM events WHERE event_type = 'purchase'
  UNION SELECT 'f' || (user_id % 10), 'S' FROM events)""", sql="""SELECT event_id,
  array_to_string(list_sort(list(DISTINCT technique)), ',') AS techniques
  FROM commands JOIN dictionary ON contains(cmd, pattern) GROUP BY event_id""")
_add("document_techniques", sql=f"""SELECT technique, count(*) AS n_lines FROM (
  SELECT unnest({_tags('text')}) AS technique FROM documents) GROUP BY technique""")
_add("top_commands", LINES, ARGS, sql="""SELECT cmd, count(*) AS n_lines FROM commands GROUP BY cmd
  ORDER BY n_lines DESC, cmd LIMIT 10""")
_add("top_messages", LINES, sql="""SELECT msg, count(*) AS n_lines FROM lines GROUP BY msg
  ORDER BY n_lines DESC, msg LIMIT 8""")
_add("top_users", LINES, sql=f"""SELECT auid, count(*) AS n_lines FROM (SELECT {_value('auid')} AS auid FROM lines)
  WHERE auid IS NOT NULL GROUP BY auid ORDER BY n_lines DESC, auid LIMIT 3""")

_add("sql_functions", LINES, ARGS, sql=f"""SELECT l.event_id, {_TYPE} AS record_type, {_RESULT} AS result, c.cmd
  FROM lines l LEFT JOIN commands c USING (event_id)""")
_add("line_hook", LINES, sql="""SELECT event_id, md5(CASE WHEN contains(msg, '): ')
  THEN substring(msg, strpos(msg, '): ') + 3) ELSE msg END) AS out_md5 FROM lines WHERE NOT starts_with(msg, 'type=PATH')""")

_add("syslog_parse", LINES, sql="""SELECT event_id, us // 1000 AS ts_ms, host, facility, severity, program,
  md5(msg) AS msg_md5 FROM lines""")
_add("pri_decode", LINES, sql=f"""SELECT event_id, facility * 8 + severity AS pri, facility, severity,
  {_FACILITY} AS facility_text, {_SEVERITY} AS severity_text FROM lines""")
_add("received_parse", LINES, sql="""SELECT event_id, us // 1000 AS ts_ms, host, program AS tag, md5(msg) AS msg_md5
  FROM lines""")
_add("blank_drop", sql=r"""SELECT doc_id, count(*) AS n_lines, CAST(sum(length(v)) AS BIGINT) AS n_chars FROM (
  SELECT doc_id, trim(l, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31)
    || ' ' || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196)
    || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233)
    || chr(8239) || chr(8287) || chr(12288)) AS v
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)) WHERE v <> '' GROUP BY doc_id""")
_add("record_type", LINES, sql=f"SELECT event_id, {_TYPE} AS record_type FROM lines")
_add("record_type_fallback", LINES, sql=f"SELECT event_id, {_first('type=([A-Z_]+)', 'UNKNOWN')} AS record_type FROM lines")
_add("audit_result", LINES, sql=f"SELECT event_id, {_RESULT} AS result FROM lines")
_add("fields_compat", LINES, sql=f"SELECT event_id, {_fields()} FROM lines")
_add("fields_strict", LINES, sql=f"SELECT event_id, {_fields(chr(92) + 'b')} FROM lines")
_add("audit_header", LINES, RECORDS, sql="SELECT event_id, record_type, epoch_ms, serial FROM records")
ORACLE["shape_user_auth"] = _shape(
    _HEAD + "pid:n uid:n auid:n ses:n op:w acct:w exe:w hostname:w addr:w terminal:w res:w",
    body=_MID + r'op=(\S+) acct="([^"]*)" exe="([^"]*)" hostname=(\S+) addr=(\d{1,3}(?:\.\d{1,3}){3}) '
    r"terminal=(\S+) res=([^\s']+)",
)
ORACLE["shape_user_cmd"] = _shape(
    _HEAD + "pid:n uid:n auid:n ses:n cwd:w cmd:w terminal:w res:w",
    body=_MID + r'cwd="([^"]*)" cmd=("[^"]*"|\S+) terminal=(\S+) ' + r"res=([^\s']+)",
)
ORACLE["shape_user_cmd"] = f"SELECT *, decode(unhex(cmd)) AS command FROM ({ORACLE['shape_user_cmd']})"
_SYSCALL_NUMBERS = "items ppid pid auid uid gid euid suid fsuid egid sgid fsgid".split()
ORACLE["shape_syscall"] = _shape(
    _HEAD + "arch:w syscall:n success:w exit:n a0:w a1:w a2:w a3:w "
    + " ".join(n + ":n" for n in _SYSCALL_NUMBERS) + " tty:w ses:n comm:w exe:w key:w",
    body=r"arch=(\S+) syscall=(\d+) success=(\S+) exit=(-?\d+) a0=(\S+) a1=(\S+) a2=(\S+) a3=(\S+) "
    + " ".join(rf"{n}=(\d+)" for n in _SYSCALL_NUMBERS)
    + r' tty=(\S+) ses=(\d+) comm="([^"]*)" exe="([^"]*)" key="([^"]*)"',
)
ORACLE["shape_execve"] = _shape(
    _HEAD + "argc:n a0:w a1:w a2:w a3:w", text="(msg || ' a3=\"' || event_type || '\"')",
    body=r'argc=(\d+) a0="([^"]*)" a1="([^"]*)" a2="([^"]*)" a3="([^"]*)"',
)
_TOKEN = r"""(?:^|[\s\x1d''])([A-Za-z_][\w-]*(?:\[\d+\])?)=("[^"]*"|[^\s''\x1d"]*)"""
_add("kv_names", LINES, sql=f"""SELECT name, count(*) AS n, min(v) AS low, max(v) AS high FROM (
  SELECT event_id, name, arg_min(trim(v, '"'), p) AS v FROM (
    SELECT event_id, unnest(regexp_extract_all(msg, '{_TOKEN}', 1)) AS name, unnest(regexp_extract_all(msg, '{_TOKEN}', 2)) AS v,
      unnest(range(len(regexp_extract_all(msg, '{_TOKEN}', 1)))) AS p FROM lines) GROUP BY event_id, name) GROUP BY name""")
_add("id_predicates", LINES, sql=f"""SELECT coalesce(auid <> '4294967295' AND CAST(auid AS BIGINT) >= 1000, FALSE) AS person,
  coalesce(auid = '4294967295', TRUE) AS unset, coalesce(uid = '0', FALSE) AS root, count(*) AS n_lines
  FROM (SELECT {_value('auid')} AS auid, {_value('uid')} AS uid FROM lines) GROUP BY 1, 2, 3""")

for _p in ("universal", "debian", "rhel", "manual"):
    _add(f"route_{_p}", LINES, sql=f"SELECT event_id, {_routed(_p)} AS route FROM lines")
_add("split_outputs", LINES, sql=f"""SELECT output, program, count(*) AS n_lines FROM (
  SELECT 'raw' AS output, program FROM lines WHERE {_routed('debian')} = 'FORWARD' UNION ALL
  SELECT 'enrich', program FROM lines WHERE {_routed('debian')} = 'FORWARD' AND contains(msg, 'type=EXECVE'))
  GROUP BY output, program""")
_PROCESSED = f"""SELECT l.event_id, 'FORWARD' AS route, o.cmd, nullif(o.tags, '') AS mitre_techniques,
  md5(coalesce(o.line_out, l.msg)) AS out_md5 FROM lines l LEFT JOIN outs o USING (event_id)
  WHERE {_routed('debian')} = 'FORWARD'"""
_add("processed_lines", LINES, ARGS, NAMES, ENRICHED, sql=_PROCESSED)
_add("ignore_lookup", LINES, sql=f"""SELECT program, event_id,
  CASE WHEN {_in('program', IGNORED_PROGRAMS)} THEN 'IGNORE' ELSE 'PASS' END AS action FROM lines""")
_add("ignore_drop", LINES, sql=f"SELECT program, event_id FROM lines WHERE NOT {_in('program', IGNORED_PROGRAMS)}")
_add("selector_sinks", LINES, sql=f"""
  SELECT event_id, 'kern.log' AS sink FROM lines WHERE facility = 0 AND severity <= 4 UNION ALL
  SELECT event_id, 'auth.log' FROM lines WHERE facility IN (4, 10) UNION ALL
  SELECT event_id, 'syslog' FROM lines WHERE facility NOT IN (4, 10) UNION ALL
  SELECT event_id, 'all-users' FROM lines WHERE severity = 0 UNION ALL
  SELECT event_id, 'audit-copy' FROM lines WHERE facility = 19""")
_add("exclude_types", LINES, sql=f"SELECT event_id FROM lines WHERE {_TYPE} NOT IN ('PATH', 'USER_AUTH')")
_add("security_keywords", LINES, sql=f"""SELECT event_id, msg FROM lines
  WHERE regexp_matches(msg, '(?i)(?:{'|'.join(SECURITY_KEYWORDS)})')""")
_add("noise_text", LINES, sql="SELECT event_id FROM lines WHERE msg NOT IN ('click message', 'view message')")
_add("document_keywords", sql="""SELECT doc_id, 'keyword' AS test FROM documents
  WHERE regexp_matches(text, '(?i)(?:error|attack|the)') UNION ALL
  SELECT doc_id, 'no text' FROM documents WHERE NOT regexp_matches(text, '(?i)the')""")
_add("message_search", LINES, sql="SELECT event_id, host FROM lines WHERE contains(msg, 'access denied')")
_add("message_exists", LINES, sql="SELECT bool_or(contains(msg, 'access denied')) AS found FROM lines")
_add("document_search", sql="SELECT doc_id FROM documents WHERE contains(text, 'th')")

_STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
_add("render_rfc3339", LINES, sql="SELECT event_id, line AS line_out FROM lines")
_add("render_received", LINES, sql=f"""SELECT event_id, {_STAMP} || ' ' || host || ' ' || program || ' ' || msg AS line_out
  FROM lines""")
_add("render_traditional", LINES, sql=f"SELECT event_id, {_TRADITIONAL} AS line_out FROM lines")
_add("render_leef", LINES, FIELDED, sql=f"SELECT event_id, {_leef()} AS line_out FROM fielded")
_add("render_json", LINES, FIELDED, sql="SELECT event_id, host, audit_type, exe, cmd FROM fielded")
_add("render_octets", LINES, sql="SELECT event_id, strlen(line) || ' ' || line AS line_out FROM lines")
_add("dual_format", LINES, FIELDED, sql=f"""SELECT event_id, 'leef' AS format, md5({_leef()}) AS out_md5 FROM fielded
  UNION ALL SELECT event_id, 'traditional', md5({_TRADITIONAL}) FROM fielded""")

_add("direct_tail", LINES, RECORDS, f"""tail AS (SELECT host, epoch_ms, make_timestamp(epoch_ms * 1000) AS ts, 'audit-direct' AS program,
  'node=' || host || ' ' || msg AS msg FROM records WHERE program = 'audit'),
fielded AS (SELECT *, {_fields()}, {_FALLBACK} AS cmd FROM tail)""", sql=f"""SELECT host, epoch_ms AS ts_ms, 'leef' AS format,
  md5({_leef()}) AS out_md5 FROM fielded UNION ALL SELECT host, epoch_ms, 'traditional', md5({_TRADITIONAL}) FROM fielded""")
_add("syslog_files", LINES, sql="""SELECT CASE WHEN program = 'kernel' THEN 'messages' ELSE 'syslog' END AS source, program,
  facility, severity, count(*) AS n_lines, min(us // 1000) AS first_ms FROM lines GROUP BY 1, 2, 3, 4""")
_add("audit_dispatch", LINES, RECORDS, sql="SELECT event_id, 19 AS facility, 'local3' AS facility_text FROM records WHERE epoch_ms IS NOT NULL")
_add("lookup_file", LINES, sql="""SELECT program, event_id, CASE WHEN program IN ('cron', 'nginx', 'postfix') THEN 'IGNORE'
  ELSE 'PASS' END AS action FROM lines""")
_add("yearless_stamps", sql="""SELECT event_id, strftime(DATE '2021-03-01' + CAST(event_id % 900 AS INTEGER), '%Y-%m-%d') || ' 10:00:00' AS ts
  FROM events""")
_add("received_report", LINES, sql=f"SELECT count(*) AS received FROM lines WHERE {_routed('universal')} = 'FORWARD'")
_UNWANTED = ", ".join(_q(p) for p in UNWANTED_PROGRAMS)
_add("unwanted_programs", LINES, sql=f"""SELECT p.program, count(l.event_id) AS n_lines, count(l.event_id) > 0 AS seen
  FROM (SELECT unnest([{_UNWANTED}]) AS program) p LEFT JOIN lines l ON contains(l.line, p.program) GROUP BY p.program""")
_add("unwanted_count", LINES, sql=f"""SELECT count(DISTINCT p.program) AS unwanted_programs
  FROM (SELECT unnest([{_UNWANTED}]) AS program) p JOIN lines l ON contains(l.line, p.program)
  WHERE {_routed('debian').replace('program', 'l.program')} = 'FORWARD'""")
_add("volume_since", LINES, sql="SELECT count(*) AS n_lines FROM lines WHERE us >= 1705276800000000")
_add("eps_by_minute", LINES, sql="""SELECT us // 60000000 * 60000000 AS start_us, host, count(*) AS n_lines
  FROM lines GROUP BY 1, 2""")
_add("sliding_volume", LINES, sql="""SELECT (us // 300000000 - back) * 300000000 AS start_us, host, count(*) AS n_lines
  FROM lines, range(2) r(back) GROUP BY 1, 2""")
_add("host_bursts", LINES, """steps AS (SELECT host, us, CASE WHEN us - lag(us) OVER w <= 1800000000 THEN 0 ELSE 1 END AS new
  FROM lines WINDOW w AS (PARTITION BY host ORDER BY us, event_id)),
runs AS (SELECT host, us, sum(new) OVER (PARTITION BY host ORDER BY us ROWS UNBOUNDED PRECEDING) AS run FROM steps)""",
  sql="""SELECT host, min(us) AS first_us, max(us) AS last_us, count(*) AS n_lines FROM runs GROUP BY host, run""")
_add("volume_reduction", LINES, sql=f"""SELECT route, program, CAST(grouping(route, program) AS INTEGER) AS level,
  count(*) AS n_lines FROM (SELECT {_routed('debian')} AS route, program FROM lines) GROUP BY ROLLUP (route, program)""")
_add("result_ratio", LINES, sql=f"""SELECT record_type, program, count(*) AS n_lines,
  count(*) FILTER (WHERE result = 'failed') AS n_failed,
  count(*) FILTER (WHERE result = 'failed') * 1000 // count(*) AS failed_per_mille
  FROM (SELECT {_TYPE} AS record_type, program, {_RESULT} AS result FROM lines) GROUP BY record_type, program""")

_add("event_assembly", LINES, ARGS, RECORDS, EVENTS, sql="SELECT * FROM assembled")
# What the split commands were made from; an event has one EXECVE line.
_add("split_commands", LINES, RECORDS, sql="""SELECT host, epoch_ms, serial, 8 * count(*) AS n_records,
  'run -x ' || repeat('é' || min(event_id), 3) || ' ' || min(event_id) || ' end' AS cmd
  FROM records WHERE record_type = 'EXECVE' GROUP BY host, epoch_ms, serial""")
_add("event_enrichment", LINES, ARGS, NAMES, RECORDS, EVENTS, sql=f"""SELECT a.host, a.epoch_ms, a.serial, a.cmd,
  nullif(array_to_string({_tags('a.cmd')}, ','), '') AS mitre_techniques, p1.name AS auid_name, p2.name AS uid_name,
  p3.name AS gid_name FROM assembled a LEFT JOIN passwd p1 ON p1.host = a.host AND p1.id = a.auid_id
  LEFT JOIN passwd p2 ON p2.host = a.host AND p2.id = a.uid_id LEFT JOIN grp p3 ON p3.host = a.host AND p3.id = a.gid_id""")
_add("event_search", LINES, RECORDS, sql="""SELECT event_id, epoch_ms, serial FROM records WHERE epoch_ms >= 1704067300000
  AND record_type = 'SYSCALL' AND contains(msg, ' success=yes ') AND contains(msg, ' comm="sudo" ')""")
_add("event_search_across", LINES, RECORDS, sql="""SELECT r.event_id, r.epoch_ms, r.serial, r.record_type FROM records r
  WHERE r.serial IS NOT NULL
  AND EXISTS (SELECT 1 FROM records o WHERE o.host = r.host AND o.epoch_ms = r.epoch_ms AND o.serial = r.serial
    AND o.record_type = 'PATH')
  AND EXISTS (SELECT 1 FROM records o WHERE o.host = r.host AND o.epoch_ms = r.epoch_ms AND o.serial = r.serial
    AND contains(o.msg, ' comm="sudo" '))""")
_add("event_paths", LINES, RECORDS, sql=f"""SELECT DISTINCT host, epoch_ms, serial,
  CAST(regexp_extract(msg, ' item=(\\d+) ', 1) AS INTEGER) AS item, {_value('name')} AS path,
  regexp_extract(msg, 'nametype=(\\w+)', 1) AS nametype FROM records WHERE record_type = 'PATH' AND serial IS NOT NULL""")
_add("undated_lines", LINES, sql="""SELECT host, count(*) AS n_lines FROM (
  SELECT CASE WHEN event_id % 10 = 3 THEN NULL ELSE ts END AS ts, host FROM lines) WHERE ts IS NULL GROUP BY host""")
# The two halves of the odd lines, stated as the values they were made from.
_add("odd_fields", sql="""SELECT event_id, '/srv/my files/' || event_type AS name, 'Web ' || user_id AS comm,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'k' || user_id END AS "key", '/opt/a b/' || event_id AS exe,
  '/tmp/' || chr(65533) || chr(65533) || event_id AS cwd
  FROM events""")
_add("odd_rendering", LINES, sql=r"""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '-' ELSE host END || ' ' ||
  CASE WHEN event_id % 5 = 0 THEN '-' ELSE program END || ': ' || msg AS tail FROM lines""")
_add("event_records_by_key", LINES, RECORDS, sql="""SELECT r.event_id, r.host, r.epoch_ms, r.serial, r.record_type
  FROM records r WHERE r.epoch_ms >= 1704067300000 AND EXISTS (SELECT 1 FROM records o WHERE o.host = r.host
  AND o.epoch_ms = r.epoch_ms AND o.serial = r.serial AND contains(o.msg, ' key="T1169_Sudo"'))""")
_add("key_tagging", LINES, sql=rf"""SELECT event_id, {_value('key')} AS key,
  nullif(regexp_extract({_value('key')}, '^(T\d{{4}})', 1), '') AS technique FROM lines""")
_add("union_source_counts", LINES, sql="""SELECT program, count(*) AS n_lines FROM (
  SELECT program FROM lines UNION ALL SELECT 'audit-direct' FROM lines WHERE program = 'audit') GROUP BY program""")
_add("dedup_sources", LINES, sql="SELECT event_id, program, md5(msg) AS msg_md5 FROM lines")
_add("delivery_gap", LINES, sql=f"""SELECT host, sha256(msg) AS digest, count(*) AS sent,
  count(*) FILTER (WHERE {_routed('debian')} = 'FORWARD') AS received,
  count(*) - count(*) FILTER (WHERE {_routed('debian')} = 'FORWARD') AS missing
  FROM lines GROUP BY host, msg HAVING count(*) > count(*) FILTER (WHERE {_routed('debian')} = 'FORWARD')""")
ORACLE["repeat_reduction"] = REPEATS
_add(
    "document_line_repeats",
    """parts AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
    unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)""",
    _runs("parts", "doc_id", "pos", "text"),
    sql="""SELECT doc_id, md5(any_value(text)) AS text_md5, count(*) AS repeats, CAST(min(pos) AS INTEGER) AS first_at,
  CAST(max(pos) AS INTEGER) AS last_at FROM islands GROUP BY doc_id, run""",
)
_SECONDS = "seconds AS (SELECT *, epoch_ms // 1000 AS second FROM records WHERE epoch_ms IS NOT NULL)"
_add("rate_cap", LINES, RECORDS, _SECONDS, sql="""SELECT event_id, host, second, serial FROM seconds
  QUALIFY row_number() OVER (PARTITION BY host, second ORDER BY serial, event_id) <= 2""")
_add("rate_cap_report", LINES, RECORDS, _SECONDS, sql="""SELECT host, second, count(*) AS n_rows, least(count(*), 2) AS kept,
  count(*) - least(count(*), 2) AS dropped FROM seconds GROUP BY host, second""")
_add("tail_lines", LINES, sql="SELECT event_id, line FROM lines ORDER BY us DESC, event_id DESC LIMIT 5")

_add("rule_parse", RULE_LINES, sql="""SELECT ruleset, idx, kind, list, action, path, is_dir, perm, syscalls, fields, key,
  technique FROM rule_rows""")
_add("rules_inventory", RULE_LINES, sql="""SELECT ruleset, kind, key, count(*) AS n_rules FROM rule_rows
  GROUP BY ruleset, kind, key""")
_add("rule_key_technique", RULE_LINES, sql="""SELECT key, technique, count(*) AS n_rules FROM rule_rows
  WHERE key IS NOT NULL GROUP BY key, technique""")
_add("ruleset_diff", RULE_LINES, sql=f"""SELECT signature, n_a, n_b,
  CASE WHEN n_b = 0 THEN 'only_a' WHEN n_a = 0 THEN 'only_b' ELSE 'both' END AS side FROM (
  SELECT {_SIGNATURE} AS signature, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS n_a,
    count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS n_b FROM rule_rows GROUP BY 1)""")
# Rules of the listings cover each other only if they are of one kind, user and bitness.
_add("dead_rules", sql="""SELECT ruleset, CAST(idx AS INTEGER) AS idx, CAST(first AS INTEGER) AS covered_by FROM (
  SELECT 'host' || (event_id // 8 % 16) AS ruleset, event_id AS idx,
    min(event_id) OVER (PARTITION BY event_id // 8 % 16, event_id % 8, user_id) AS first
  FROM events WHERE event_id % 8 IN (0, 1, 3, 4)) WHERE idx > first""")
_add("rules_strict", RULE_LINES, sql=f"""SELECT ruleset, kind, count(*) AS n_rules, CAST(sum(idx) AS BIGINT) AS sum_idx FROM (
  SELECT ruleset, kind, min(idx) AS idx FROM (SELECT *, {_SIGNATURE} AS signature FROM rule_rows)
  WHERE kind <> 'control' GROUP BY ruleset, kind, signature) GROUP BY ruleset, kind""")
_add("normalized_events", LINES, RECORDS, RULE_EVENTS, sql="SELECT *, 4 AS access FROM rule_events")
_add("watch_match", LINES, *_RULED, sql="""SELECT host, epoch_ms, serial, path, ruleset, idx, key FROM matches
  WHERE kind = 'watch'""")
_add("syscall_match", LINES, *_RULED, sql="""SELECT host, epoch_ms, serial, path, ruleset, idx, key FROM matches
  WHERE kind = 'syscall'""")
_add("rule_disposition", LINES, *_RULED, sql=r"""SELECT host, epoch_ms, serial, ruleset, idx, key,
  nullif(regexp_extract(key, '^(T\d{4})', 1), '') AS technique FROM deciding WHERE action = 'always'""")
_add("ruleset_whatif", LINES, *_RULED, sql="""SELECT ruleset, key, count(*) AS n_events FROM deciding
  WHERE action = 'always' GROUP BY ruleset, key""")
_add("never_rules", LINES, RECORDS, RULE_EVENTS, sql="""SELECT host, epoch_ms, serial, path FROM rule_events e
  WHERE NOT EXISTS (SELECT 1 FROM rule_events o WHERE o.host = e.host AND o.epoch_ms = e.epoch_ms AND o.serial = e.serial
  AND o.success = 1 AND starts_with(o.path, '/etc/'))""")
_add("exclude_rules", LINES, RECORDS, sql="""SELECT event_id, record_type FROM records
  WHERE record_type NOT IN ('PATH', 'USER_CMD')""")
_add("record_verdicts", LINES, RECORDS, RULE_EVENTS, sql=rf"""SELECT event_id, "list", idx, idx IS NULL AND NOT coalesce(called, FALSE) OR coalesce(idx = 5, FALSE) AS kept
  FROM (SELECT event_id, called, CASE WHEN idx < 2 THEN 'exclude' WHEN idx < 4 THEN 'user' WHEN idx < 6 THEN 'exit' END AS "list", idx FROM (
    SELECT event_id, e.host IS NOT NULL AND record_type IN ('SYSCALL', 'PATH', 'EXECVE') AS called, CAST(CASE WHEN record_type = 'PATH' THEN 0
      WHEN record_type = 'EXECVE' AND {_value('auid')} = '1002' THEN 1 WHEN record_type = 'USER_CMD' AND {_value('auid')} = '1003' THEN 2
      WHEN starts_with(record_type, 'USER') AND record_type <> 'USER_CMD' AND {_value('auid')} = '1004' THEN 3
      WHEN record_type IN ('SYSCALL', 'EXECVE') AND e.etc THEN 4 WHEN record_type IN ('SYSCALL', 'EXECVE') AND e.done THEN 5 END AS INTEGER) AS idx
    FROM records r LEFT JOIN (SELECT host, epoch_ms, serial, coalesce(bool_or(success = 1 AND starts_with(path, '/etc/')), FALSE) AS etc, bool_or(success = 1) AS done
      FROM rule_events GROUP BY ALL) e USING (host, epoch_ms, serial)))""")

ORACLE["stream_route_enrich"] = ORACLE["processed_lines"]
# Windows and events the watermark (ten minutes behind the newest time) has passed.
_add("stream_eps", LINES, sql="""SELECT start_us, host, n_lines FROM (
  SELECT us // 300000000 * 300000000 AS start_us, host, count(*) AS n_lines FROM lines GROUP BY 1, 2)
  WHERE start_us + 300000000 <= (SELECT max(us) // 1000 * 1000 - 600000000 FROM lines)""")
_add("stream_assembly", LINES, ARGS, RECORDS, EVENTS, sql="""SELECT host, epoch_ms, serial, n_records, cmd, path, auid_id,
  "key", failed FROM assembled""")
_add("stream_dedup", LINES, sql="SELECT event_id, program, md5(msg) AS msg_md5 FROM lines")
_add("stream_late", LINES, RECORDS, sql="""SELECT 'assembled' AS output, count(*) AS n FROM records
  WHERE epoch_ms IS NOT NULL AND NOT (event_id % 97 = 0 AND event_id < 400)
  UNION ALL SELECT 'late ' || event_id, 1 FROM records WHERE epoch_ms IS NOT NULL AND event_id % 97 = 0 AND event_id < 400""")
ORACLE["stream_repeat"] = ORACLE["repeat_reduction"]
ORACLE["stream_bursts"] = ORACLE["host_bursts"]
_add("stream_gap", LINES, sql=f"""SELECT host, us, digest, sent, received, sent - received AS missing FROM (
  SELECT host, us, sha256(msg) AS digest, count(*) AS sent, count(*) FILTER (WHERE {_routed('debian')} = 'FORWARD'
  AND NOT (event_id % 97 = 0 AND event_id < 400)) AS received FROM lines GROUP BY host, us, msg) WHERE sent > received""")
