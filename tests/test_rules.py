import itertools
import random
import re
from collections import defaultdict

import pytest

from logforge.operators import rule_match as M
from logforge.rulesets import RULESETS, rule_rows
from logforge.sources import rules as S
from logforge.sources.logs import parse_audit

TEXT = """## header
-D
-b 8192

-e 2
-w /etc/passwd -p wa -k identity
-w /var/log/audit/ -k T1005_audit
  -a exit,always -F arch=b64 -S open -F dir=/etc -F success=0 -k T1068_x
-a always,exit -F arch=b32 -S useradd,mount -S umount -F auid>=1000 -F auid!=4294967295 -F key=m
-a never,user -F subj_type=crond_t
-w /home/*/.ssh/ -p wa -k glob
-a always,exit -F arch=b64 -S useradd -k tool
-w /etc/passwd -p wa -k identity
"""


@pytest.fixture
def parsed(spark, tmp_path):
    (tmp_path / "site.rules").write_text(TEXT)
    return S.read_rules(spark, str(tmp_path / "site.rules"))


def test_parse(parsed):
    rows = parsed.orderBy("idx").collect()
    assert [r["kind"] for r in rows] == ["control", "control", "watch", "watch", "syscall", "syscall", "syscall", "watch", "syscall", "watch", "control"]
    assert {r["ruleset"] for r in rows} == {"site"}
    passwd, audit, opened, mount, never = rows[2:7]
    assert (passwd["path"], passwd["is_dir"], passwd["perm"], passwd["key"]) == ("/etc/passwd", False, "wa", "identity")
    assert (audit["path"], audit["is_dir"], audit["perm"], audit["technique"]) == ("/var/log/audit", True, "rwxa", "T1005")
    assert (opened["list"], opened["action"], opened["syscalls"], opened["technique"]) == ("exit", "always", ["open"], "T1068")
    assert [tuple(f) for f in opened["fields"]] == [("arch", "=", "b64"), ("dir", "=", "/etc"), ("success", "=", "0")]
    assert mount["syscalls"] == ["useradd", "mount", "umount"] and mount["key"] == "m"
    assert [tuple(f) for f in mount["fields"]][1:] == [("auid", ">=", "1000"), ("auid", "!=", "4294967295")]
    assert (never["list"], never["action"], never["key"]) == ("user", "never", None)


def test_strict_drops_defects(parsed):
    rows = S.strict_rules(parsed).orderBy("idx").collect()
    assert [r["key"] for r in rows if r["kind"] == "watch"] == ["identity", "T1005_audit"]
    assert [r["syscalls"] for r in rows if r["key"] == "m"] == [["mount", "umount"]]
    assert not [r for r in rows if r["key"] == "tool"]


def test_shipped_counts():
    count = lambda n: (sum("watch" in r for r in RULESETS[n]), sum("where" in r for r in RULESETS[n]), len({r["key"] for r in RULESETS[n]}))
    assert count("universal") == (22, 20, 22)
    assert count("universal_minimal") == (0, 8, 4)
    assert count("host_minimal") == (11, 10, 10)
    assert count("manual")[:2] == (58, 10)


def test_diff(spark):
    a, b = S.builtin_rules(spark, "universal"), S.builtin_rules(spark, "universal", "manual")
    assert S.ruleset_diff(a, a).filter("side <> 'both'").count() == 0
    sides = {r["side"] for r in S.ruleset_diff(a, b).collect()}
    assert sides == {"both", "only_b"}


RECORDS = [
    # (host, serial, syscall number, fields, path)
    ("h", 1, 59, "success=yes exit=0 uid=0 auid=1000", "/etc/shadow"),
    ("h", 2, 2, "success=no exit=-13 a1=0 uid=5 auid=4294967295", "/etc/sudoers.d/x"),
    ("h", 3, 257, "success=yes exit=3 a2=1 uid=5 auid=1001", "/home/u/f"),
    ("h", 4, 101, "success=yes exit=0 a0=10 uid=0 auid=1001", None),
    ("h", 5, 87, "success=yes exit=0 uid=1 auid=1001", "/dev/shm/t"),
    ("h", 6, 90, "success=yes exit=0 uid=1 auid=1001", "/etc/passwd"),
    ("h", 7, 59, "success=yes exit=0 uid=1 auid=1001 subj=system_u:system_r:crond_t:s0", "/usr/bin/curl"),
    ("h", 8, 57, "success=no exit=-2 uid=1 auid=1001 subj=a:b:initrc_t:s0", "/usr/lib/vmware-tools"),
    ("h", 9, 105, "success=no exit=-1 uid=1 auid=1001", None),
]
CALLS = {59: "execve", 2: "open", 257: "openat", 101: "ptrace", 87: "unlink", 90: "chmod", 57: "fork", 105: "setuid"}
ACCESS = {1: "x", 2: "r", 3: "w", 5: "w", 6: "a", 7: "x"}


def brute(rule, rec):
    """Does one rule match one event?  Stated row by row."""
    _, idx, kind, to_list, action, path, is_dir, perm, calls, fields, key = rule
    _, serial, number, text, touched = rec
    access = ACCESS.get(serial, "")
    if to_list != "exit":
        return False
    under = lambda d: touched is not None and (touched == d or touched.startswith(d + "/"))
    if kind == "watch":
        return bool(set(perm) & set(access)) and under(path)
    if calls and "all" not in calls and CALLS[number] not in calls:
        return False
    attrs = dict(re.findall(r"(\w+)=(\S+)", text))
    for name, op, value in fields:
        if name == "arch":
            ok = value == "b64"
        elif name == "dir":
            ok = under(value)
        elif name == "path":
            ok = touched == value
        elif name == "perm":
            ok = bool(set(value) & set(access))
        elif name == "subj_type":
            ok = attrs.get("subj", ":::").split(":")[2] == value
        elif name == "success":
            ok = value == ("1" if attrs["success"] == "yes" else "0")
        elif name == "a0":
            ok = "a0" in attrs and int(attrs["a0"], 16) == int(value, 0)
        else:
            have = attrs.get(name)
            value = "0" if value == "root" else value
            unset = name.endswith("uid") and have in (None, "4294967295", "-1")
            if value in ("4294967295", "-1", "unset") and name.endswith("uid"):
                ok = unset if op == "=" else not unset
            elif unset or have is None or not re.fullmatch(r"-?\d+", value):
                ok = False
            else:
                ok = {"=": int(have) == int(value), "!=": int(have) != int(value), ">=": int(have) >= int(value)}[op]
        if not ok:
            return False
    return True


@pytest.fixture
def events(spark):
    rows = []
    for host, serial, number, text, path in RECORDS:
        head = f"msg=audit(1.000:{serial}):"
        call = f"type=SYSCALL {head} arch=c000003e syscall={number} {text}"
        rows += [(host, call), (host, call)]  # copies must not multiply
        if path:
            rows.append((host, f'type=PATH {head} item=0 name="{path}"'))
    return M.normalize_events(parse_audit(spark.createDataFrame(rows, "host STRING, msg STRING")))


def test_matches_equal_brute_force(spark, events):
    got = {(r["serial"], r["ruleset"], r["idx"]) for r in M.match_rules(events, S.builtin_rules(spark)).collect()}
    want = {
        (rec[1], rule[0], rule[1]) for name in RULESETS for rule in rule_rows(name) for rec in RECORDS if brute(rule, rec)
    }
    assert got == want and {s for s, _, _ in got} == set(range(1, 10)) - {2}


def test_first_match_decides(spark, events):
    lines = [
        ("r", 0, "-a never,exit -F arch=b64 -F dir=/dev/shm -k quiet"),
        ("r", 1, "-a always,exit -F arch=b64 -S open -F exit=-EACCES -k denied"),
        ("r", 2, "-a exit,always -F arch=b64 -S all -k all"),
        ("r", 3, "-w /etc/passwd -p a -k late"),
    ]
    own = S.parse_rules(spark.createDataFrame(lines, "ruleset STRING, idx INT, value STRING"))
    logged = {r["serial"]: r["key"] for r in M.disposition(M.match_rules(events, own)).collect()}
    assert logged == {s: "denied" if s == 2 else "all" for s in range(1, 10) if s != 5}
    assert {r["serial"] for r in M.apply_never(events, own).collect()} == set(range(1, 10)) - {5}


def test_excludes(spark):
    df = parse_audit(spark.createDataFrame([("type=AVC",), ("type=PATH",), ("type=CWD",)], "msg STRING"))
    assert [r["record_type"] for r in M.apply_excludes(df, S.builtin_rules(spark, "filters")).collect()] == ["PATH"]


def test_watch_of_a_directory_without_a_slash(spark):
    rows = [("h", "type=SYSCALL msg=audit(1.000:1): arch=c000003e syscall=90 success=yes"), ("h", 'type=PATH msg=audit(1.000:1): item=0 name="/etc/chef/a.rb"')]
    events = M.normalize_events(parse_audit(spark.createDataFrame(rows, "host STRING, msg STRING")))
    lines = [("r", 0, "-w /etc/che -p a -k no"), ("r", 1, "-w /etc/chef -p a -k yes"), ("r", 2, "-w /etc/chef/a.rb/ -p a -k own")]
    own = S.parse_rules(spark.createDataFrame(lines, "ruleset STRING, idx INT, value STRING"))
    assert sorted(r["key"] for r in M.match_rules(events, own).collect()) == ["own", "yes"]


def test_fields_against_fields_names_and_programs(spark):
    records = [(1, 'uid=1000 euid=0 auid=1000 exe="/usr/bin/su"'), (2, 'uid=0 euid=0 auid=4294967295 exe="/bin/ls"'), (3, 'uid=5 euid=5 auid=7 exe="/bin/ls"')]
    rows = [("h", f"type=SYSCALL msg=audit(1.000:{k}): arch=c000003e syscall=59 success=yes {text}") for k, text in records]
    events = M.normalize_events(parse_audit(spark.createDataFrame(rows, "host STRING, msg STRING")))
    lines = ["-C uid!=euid", "-C uid=auid", "-F uid=root", "-F euid!=root", "-F exe=/bin/ls", "-F exe!=/bin/ls"]
    rules = S.parse_rules(spark.createDataFrame([("r", k, f"-a always,exit -F arch=b64 -S execve {t}") for k, t in enumerate(lines)], "ruleset STRING, idx INT, value STRING"))
    assert M.unsupported_rules(rules).collect() == []
    got = {k: sorted(r["serial"] for r in M.match_rules(events, rules).filter(f"idx = {k}").collect()) for k in range(6)}
    assert got == {0: [1], 1: [1], 2: [2], 3: [3], 4: [2, 3], 5: [1]}


def test_covered_rules(spark):
    """No event that a covered rule matches escapes the rule before it, over all combinations of small values."""
    rng = random.Random(6)
    tests = ["-F auid>=5", "-F auid>4", "-F auid<=6", "-F auid!=unset", "-F auid=5", "-F auid!=5", "-F auid=unset", "-F success=0", "-F uid=root", "-C uid!=auid", "-F dir=/a", "-F dir=/a/b", "-F path=/a/b", "-F perm=wa", "-F perm=a", "-F uid<3", "-F uid>=0"]
    lines = [f"-a always,exit -F arch=b64 {rng.choice(('-S open', '-S chmod', '-S open,chmod', ''))} " + " ".join(rng.sample(tests, rng.randrange(0, 3))) for _ in range(70)]
    lines += [f"-w {p} -p {x}" for p in ("/a", "/a/", "/a/b", "/ab") for x in ("a", "wa", "r")]
    rng.shuffle(lines)
    rules = S.parse_rules(spark.createDataFrame([("r", k, x) for k, x in enumerate(lines)], "ruleset STRING, idx INT, value STRING"))
    found = {(r["idx"], r["covered_by"]) for r in M.covered_rules(rules).collect()}
    rows, serial = [], 0
    for call, ok, uid, auid, path in itertools.product((2, 90), ("yes", "no"), (0, 3, 5), (4, 5, 6, 7, 4294967295), (None, "/a", "/a/b", "/a/b/c", "/ab")):
        serial += 1
        rows.append(("h", f"type=SYSCALL msg=audit(1.000:{serial}): arch=c000003e syscall={call} success={ok} a1=1 uid={uid} auid={auid}"))
        if path:
            rows.append(("h", f'type=PATH msg=audit(1.000:{serial}): item=0 name="{path}"'))
    events = M.normalize_events(parse_audit(spark.createDataFrame(rows, "host STRING, msg STRING")))
    hits = defaultdict(set)
    for r in M.match_rules(events, rules).select("idx", "serial").collect():
        hits[r["idx"]].add(r["serial"])
    assert all(hits[b] <= hits[a] and a < b for b, a in found) and len(found) > 25
    # A rule that matches the same or less than an earlier one with the same tests is found.
    same = {b for b, a in itertools.product(range(len(lines)), repeat=2) if a < b and lines[a] == lines[b]}
    assert same <= {b for b, _ in found}


def test_covered_rules_of_long_listings(spark):
    """Thousands of rules of one probe and thousands of copies: as many rows as rules, not as pairs of them."""
    text = lambda k: f"-a always,exit -F arch=b64 -S open -F dir=/data/{k % 4000} -F success=0"
    lines = [("r", k, text(k) if k < 8000 else text(7)) for k in range(12_000)]
    lines += [("r", 20_000, "-a always,exit -F arch=b64 -S open -F path=/data/9/x -F success=0 -F uid=1"), ("r", 20_001, "-a always,exit -F arch=b64 -S open -F dir=/data/9000")]
    # Two rows of one number are one rule, covered only where both are; a rule that holds never covers nothing.
    lines += [("r", 20_002, text(1)), ("r", 20_002, text(5000)), ("q", 1, "-w /a -p wa"), ("q", 2, "-a always,exit -F arch=b64 -S open -F dir=/b -F inode=3"), ("q", 3, "-a always,exit -F arch=b64 -S open -F dir=/b -F inode=3"), ("q", 4, "-w /a/b -p a")]
    out = M.covered_rules(S.parse_rules(spark.createDataFrame(lines, "ruleset STRING, idx INT, value STRING")))
    # Rules of one probe are not all paired: the join asks for the key of a test as well.
    assert "ask#" in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.ruleset, r.idx): r.covered_by for r in out.collect()}
    want = {("r", k): k - 4000 if k < 8000 else 7 for k in range(4000, 12_000)} | {("r", 20_000): 9, ("q", 4): 1}
    assert got == want

