"""Audit rules applied to normalized events.

Rules and events meet in one equi join on probe keys: a system call rule is
probed by ``s:arch:call`` (or ``s:arch:*``), a watch by ``d:path`` (it holds for a
directory and all below it, however the path is written); an event probes its call, its path and every
folder above it.  No rule is compared with an event it shares no key with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.facts import ARCH_CODES, ERRNO, SYSCALLS_B32, SYSCALLS_B64, UNSET_ID
from logforge.functions.audit import field_value, id_value
from logforge.operators.events import EVENT_KEY, first_match, raw_fields
from logforge.scale import left_lookup, work_dir

_IDS = ("auid", "uid", "gid", "euid")
_NUMERIC = _IDS + ("exit", "success", "a0", "a1", "a2", "a3")
_ACCESS = {"r": 1, "w": 2, "x": 4, "a": 8}
# Calls whose kind of access follows from the call alone.
_EXECUTES = ("execve", "execveat")
_CHANGES_ATTRIBUTES = (
    "chmod", "fchmod", "fchmodat", "chown", "fchown", "lchown", "fchownat", "chown32",
    "setxattr", "lsetxattr", "fsetxattr", "removexattr", "lremovexattr", "fremovexattr",
)
_WRITES = (
    "creat", "truncate", "ftruncate", "rename", "renameat", "unlink", "unlinkat", "link",
    "linkat", "symlink", "symlinkat", "mknod", "mknodat", "mkdir", "rmdir",
)


def _lookup(key: Column, table: dict) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def _access_mask(letters: Column) -> Column:
    parts = [F.when(F.contains(letters, F.lit(c)), F.lit(m)).otherwise(0) for c, m in _ACCESS.items()]
    return sum(parts[1:], parts[0])


def _hex_number(text: Column) -> Column:
    return F.conv(text, 16, 10).try_cast("bigint")


_RAW = ("arch", "syscall", "success", "exit", "a0", "a1", "a2", "a3", "subj", "key", "exe") + _IDS


def _syscall_attributes() -> dict[str, Column]:
    """Typed attributes from the raw field texts of a SYSCALL record."""
    number = F.col("syscall").try_cast("int")
    arch = _lookup(F.col("arch"), ARCH_CODES)
    return {
        "arch": arch,
        "syscall": F.coalesce(
            F.when(arch == "b64", _lookup(number, SYSCALLS_B64)),
            F.when(arch == "b32", _lookup(number, SYSCALLS_B32)),
        ),
        "success": F.when(F.col("success") == "yes", 1).otherwise(0).cast("bigint"),
        "exit": F.col("exit").try_cast("bigint"),
        **{n: _hex_number(F.col(n)) for n in ("a0", "a1", "a2", "a3")},
        **{n: id_value(F.col(n)) for n in _IDS},
        "subj_type": F.get(F.split("subj", ":"), F.lit(2)),
        "exe": F.when(F.col("exe") != "", F.col("exe")),
        "stamped_key": F.when(F.col("key") != "", F.col("key")),
    }


def _access_of_call() -> Column:
    """Access letters of an event, as a mask, from its call and open flags."""
    call = F.col("syscall")
    mode = F.when(call == "open", F.col("a1")).when(call == "openat", F.col("a2")).bitwiseAND(3)
    opened = F.when(mode == 0, 1).when(mode == 1, 2).when(mode == 2, 3)
    return (
        F.when(call.isin(*_EXECUTES), _ACCESS["x"])
        .when(call.isin(*_CHANGES_ATTRIBUTES), _ACCESS["a"])
        .when(call.isin(*_WRITES), _ACCESS["w"])
        .when(call.isin("open", "openat"), opened)
    )


def normalize_events(records: DataFrame, line: str = "msg") -> DataFrame:
    """One row per event and path it touches (NULL path if none), with typed attributes.

    Both sides are made unique on the event before they meet, so repeated
    copies of a record cannot multiply.  Events without a path are known from
    the aggregation; the others meet their paths in an inner join, which the
    adaptive plan may split on either side if one event touches very many.
    """
    # With the keys tested here the join below adds no filter of its own, and
    # both uses of `calls` share one shuffle.
    for key in EVENT_KEY:
        records = records.filter(F.col(key).isNotNull())
    kind = F.col("record_type")
    name = F.when(kind == "PATH", field_value(line, "name"))
    calls = (
        records.filter(kind.isin("SYSCALL", "PATH"))
        .select(
            *EVENT_KEY,
            F.when(kind == "SYSCALL", raw_fields(line, _RAW)).alias("_raw"),
            name.isNotNull().alias("_named"),
        )
        .groupBy(*EVENT_KEY)
        .agg(F.min("_raw").alias("_raw"), F.max("_named").alias("_named"))
        .filter(F.col("_raw").isNotNull())
        .select(*EVENT_KEY, "_named", "_raw.*")
        .select(*EVENT_KEY, "_named", *[c.alias(n) for n, c in _syscall_attributes().items()])
        .withColumn("access", _access_of_call())
    )
    paths = (
        records.filter(kind == "PATH")
        .select(*EVENT_KEY, field_value(line, "name").alias("path"))
        .filter(F.col("path").isNotNull())
        .distinct()
    )
    bare = calls.filter(~F.col("_named")).withColumn("path", F.lit(None).cast("string"))
    touching = calls.filter("_named").join(paths, EVENT_KEY)
    return touching.unionByName(bare).drop("_named")


def _folders(path: Column) -> Column:
    """The path and every folder above it, root included."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")),
    )
    return F.when(path.startswith("/"), above)


def event_probes() -> Column:
    """Probe keys of an event row (from arch, syscall and path)."""
    arch = F.coalesce("arch", F.lit(""))
    calls = F.array(
        F.concat(F.lit("s:"), arch, F.lit(":"), F.coalesce("syscall", F.lit("?"))),
        F.concat(F.lit("s:"), arch, F.lit(":*")),
    )
    folders = F.transform(_folders(F.col("path")), lambda p: F.concat(F.lit("d:"), p))
    own = F.array(F.concat(F.lit("p:"), F.col("path")))
    return F.when(F.col("path").isNull(), calls).otherwise(
        F.concat(calls, own, F.coalesce(folders, F.array().cast("array<string>")))
    )


def _typed_fields(fields: Column) -> Column:
    """Field tests with numbers resolved: name, op, text, number, unset."""

    def typed(f: Column) -> Column:
        v = f["value"]
        errno = F.when(
            v.startswith("-"), -_lookup(F.substring(v, 2, 20), ERRNO)
        ).otherwise(_lookup(v, ERRNO))
        number = (
            F.when(f["name"] == "perm", _access_mask(v).cast("bigint"))
            .when(f["name"] == "exit", F.coalesce(v.try_cast("bigint"), errno.cast("bigint")))
            .when(f["name"].isin(*_IDS) & (v == "root"), F.lit(0).cast("bigint"))
            .when(v.startswith("0x"), _hex_number(F.substring(v, 3, 40)))
            .otherwise(v.try_cast("bigint"))
        )
        unset = f["name"].isin("auid", "uid", "gid", "euid") & v.isin(str(UNSET_ID), "-1", "unset")
        return F.struct(
            f["name"].alias("name"), f["op"].alias("op"),
            F.when(v == "/", v).otherwise(F.rtrim(v, F.lit("/"))).alias("text"),
            number.alias("number"), unset.alias("unset"),
        )

    return F.transform(F.filter(fields, lambda f: f["name"] != "arch"), typed)


def _probes_and_tests() -> tuple[Column, Column]:
    """Probe keys and typed field tests of a rule of the exit list."""
    arch = F.get(F.filter("fields", lambda f: f["name"] == "arch"), F.lit(0))["value"]
    arches = F.when(arch.isNull(), F.array(F.lit("b64"), F.lit("b32"), F.lit(""))).otherwise(
        F.array(arch)
    )
    calls = F.when(
        (F.size("syscalls") == 0) | F.array_contains("syscalls", "all"), F.array(F.lit("*"))
    ).otherwise(F.array_distinct("syscalls"))
    call_probes = F.flatten(
        F.transform(
            arches,
            lambda a: F.transform(calls, lambda c: F.concat(F.lit("s:"), a, F.lit(":"), c)),
        )
    )
    watch_probe = F.concat(F.when(F.col("path").startswith("/"), "d:").otherwise("p:"), F.col("path"))
    watch_test = F.array(
        F.struct(
            F.lit("perm").alias("name"), F.lit("=").alias("op"), F.col("perm").alias("text"),
            _access_mask(F.col("perm")).cast("bigint").alias("number"),
            F.lit(False).alias("unset"),
        )
    )
    watch = F.col("kind") == "watch"
    tests = F.when(watch, watch_test).otherwise(_typed_fields(F.col("fields")))
    return F.when(watch, F.array(watch_probe)).otherwise(call_probes), tests


def _on_exit_list() -> Column:
    return (F.col("list") == "exit") & F.col("kind").isin("watch", "syscall")


def compile_rules(rules: DataFrame) -> DataFrame:
    """Rules of the exit list, one row per probe key, with typed field tests."""
    probes, tests = _probes_and_tests()
    return rules.filter(_on_exit_list()).select(
        "ruleset", "idx", "kind", "action", "key", "technique", tests.alias("tests"), F.explode(probes).alias("probe")
    )


def _unsupported_tests() -> Column:
    """The tests of a rule that cannot be decided here, its list among them."""
    known = ("arch", "key", "perm", "dir", "path", "exe", "subj_type", "msgtype", *_NUMERIC)

    def undecided(f: Column) -> Column:
        v = f["value"]
        number = v.try_cast("bigint").isNotNull() | v.rlike("^0x[0-9A-Fa-f]+$") | (v == "unset")
        number = number | (f["name"].isin(*_IDS) & v.isin("root", *_IDS))
        named = f["name"].isin("exit") & F.coalesce(_lookup(F.ltrim(v, F.lit("-")), ERRNO).isNotNull(), F.lit(False))
        return ~f["name"].isin(*known) | (f["name"].isin(*_NUMERIC) & ~number & ~named)

    tests = F.transform(F.filter("fields", undecided), lambda f: F.concat(f["name"], f["op"], f["value"]))
    other = F.when(~F.col("list").isin("exit", "exclude", "user"), F.array(F.concat(F.lit("list="), F.col("list"))))
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(tests, none), F.coalesce(other, none))


def unsupported_rules(rules: DataFrame) -> DataFrame:
    """(ruleset, idx, tests) of the rules with tests that cannot be decided here and so never hold.

    These are fields that events do not carry, ids given by a name other than
    root, and lists other than exit, exclude and user.  Look at them before a
    disposition is trusted.
    """
    out = rules.filter(F.col("kind").isin("watch", "syscall")).select("ruleset", "idx", _unsupported_tests().alias("tests"))
    return out.filter(F.size("tests") > 0)


def _compare(op: Column, a: Column, b: Column) -> Column:
    return (
        F.when(op == "=", a == b)
        .when(op == "!=", a != b)
        .when(op == ">=", a >= b)
        .when(op == "<=", a <= b)
        .when(op == ">", a > b)
        .when(op == "<", a < b)
    )


def _holds(test: Column) -> Column:
    """Does one field test hold for the event row?"""
    name, op = test["name"], test["op"]

    def value_of(field: Column, names: tuple[str, ...]) -> Column:
        out = F.when(field == names[0], F.col(names[0]))
        for n in names[1:]:
            out = out.when(field == n, F.col(n))
        return out

    number = value_of(name, _NUMERIC)
    under = (F.col("path") == test["text"]) | F.startswith(
        F.col("path"), F.concat(test["text"], F.lit("/"))
    )
    result = (
        F.when(name == "perm", F.col("access").bitwiseAND(test["number"]) != 0)
        .when(name == "dir", under)
        .when(name == "path", _compare(op, F.col("path"), test["text"]))
        .when(name == "subj_type", _compare(op, F.col("subj_type"), test["text"]))
        .when(name == "exe", _compare(op, F.col("exe"), test["text"]))
        # One field against another (``-C``).
        .when(name.isin(*_IDS) & test["text"].isin(*_IDS), _compare(op, number, value_of(test["text"], _IDS)))
        .when(test["unset"], F.when(op == "=", number.isNull()).otherwise(number.isNotNull()))
        .when(op == "&", number.bitwiseAND(test["number"]) != 0)
        .when(op == "&=", number.bitwiseAND(test["number"]) == test["number"])
        .otherwise(_compare(op, number, test["number"]))
    )
    return F.coalesce(result, F.lit(False))


def match_rules(events: DataFrame, rules: DataFrame) -> DataFrame:
    """All (event, rule) matches: event key, path, ruleset, idx, kind, action, key, technique.

    Rules are counted and broadcast (a rule set has some hundred rows), so the
    events stay where they are.
    """
    compiled = compile_rules(rules)
    probing = events.withColumn("probe", F.explode(event_probes()))
    joined = left_lookup(probing, compiled, ["probe"], how="inner")
    return joined.filter(F.forall("tests", _holds)).select(
        *EVENT_KEY, "path", "ruleset", "idx", "kind", "action", "key", "technique"
    )


def first_rules(matches: DataFrame) -> DataFrame:
    """The rule that decides each event, per rule set: first match wins."""
    return first_match(matches.drop("path"), EVENT_KEY + ["ruleset"], "idx")


def disposition(matches: DataFrame) -> DataFrame:
    """Events that are logged, with the key of the deciding rule."""
    return first_rules(matches).filter(F.col("action") == "always")


def apply_never(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Events without those a ``never`` rule suppresses (decided per event)."""
    suppressed = (
        first_rules(match_rules(events, rules))
        .filter(F.col("action") == "never")
        .select(*EVENT_KEY)
        .distinct()
    )
    return events.join(suppressed, EVENT_KEY, "left_anti")


def apply_excludes(records: DataFrame, rules: DataFrame) -> DataFrame:
    """Records without the types named by ``exclude`` rules."""
    types = (
        rules.filter((F.col("list") == "exclude") & (F.col("action") == "always"))
        .select(F.explode("fields").alias("f"))
        .filter((F.col("f.name") == "msgtype") & (F.col("f.op") == "="))
        .select(F.col("f.value").alias("record_type"))
        .distinct()
    )
    return left_lookup(records, types, ["record_type"], how="left_anti")


def ruleset_whatif(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Per rule set and key: how many events it would log."""
    return (
        disposition(match_rules(events, rules))
        .groupBy("ruleset", "key")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def _implied(a: Column, b: Column) -> Column:
    """Does test ``a`` hold wherever test ``b`` of the same field does?  False where that cannot be told."""
    op, n, m = a["op"], a["number"], b["number"]
    plain = ~a["text"].isin(*_IDS) & ~b["text"].isin(*_IDS)
    numbers = plain & ~a["unset"] & ~b["unset"] & a["name"].isin(*_NUMERIC)
    at_least = (b["op"].isin("=", ">=") & (m >= n)) | ((b["op"] == ">") & (m >= n - 1))
    at_most = (b["op"].isin("=", "<=") & (m <= n)) | ((b["op"] == "<") & (m <= n + 1))
    differs = (
        ((b["op"] == "=") & (m != n)) | ((b["op"] == ">") & (m >= n)) | ((b["op"] == ">=") & (m > n))
        | ((b["op"] == "<") & (m <= n)) | ((b["op"] == "<=") & (m < n))
    )
    within = (b["text"] == a["text"]) | F.startswith(b["text"], F.concat(F.when(a["text"] == "/", F.lit("")).otherwise(a["text"]), F.lit("/")))
    return F.coalesce(
        F.when(
            (a["name"] == b["name"]) & (op == b["op"]) & (a["text"] == b["text"]) & n.eqNullSafe(m) & (a["unset"] == b["unset"]),
            F.lit(True),
        )
        .when(a["name"] == "dir", b["name"].isin("dir", "path") & (b["op"] == "=") & within)
        .when(a["name"] != b["name"], F.lit(False))
        .when(a["name"] == "perm", m.bitwiseAND(n) == m)
        # Any number is an id that is set.
        .when(a["unset"] & (op == "!="), plain & ~b["unset"] & m.isNotNull() & b["op"].isin("=", "!=", ">=", "<=", ">", "<"))
        .when(numbers & (op == ">="), at_least)
        .when(numbers & (op == ">"), (b["op"].isin("=", ">=") & (m > n)) | ((b["op"] == ">") & (m >= n)))
        .when(numbers & (op == "<="), at_most)
        .when(numbers & (op == "<"), (b["op"].isin("=", "<=") & (m < n)) | ((b["op"] == "<") & (m <= n)))
        .when(numbers & (op == "!="), differs),
        F.lit(False),
    )


def _wider_probes() -> Column:
    """The probe, and those of rules that see everything a rule of this probe sees."""
    probe = F.col("probe")
    call = F.array(probe, F.regexp_replace(probe, "^(s:[^:]*:).*$", "$1*"))
    folders = F.transform(_folders(F.substring(probe, 3, 1_000_000)), lambda p: F.concat(F.lit("d:"), p))
    return F.array_distinct(F.when(probe.startswith("s:"), call).when(probe.startswith("d:"), folders).otherwise(F.array(probe)))


def _asked() -> Column:
    """Keys of a rule's ``tests`` that a rule it covers must offer; intervals and sets of access ask for none."""

    def key(t: Column) -> Column:
        loose = (t["name"] == "perm") | (t["name"].isin(*_NUMERIC) & t["op"].isin("!=", ">=", ">", "<=", "<"))
        own = F.concat(F.lit("e:"), t["name"], t["op"], t["text"])
        return F.when(t["name"] == "dir", F.concat(F.lit("d:"), t["text"])).when(~loose, own)

    return F.array_distinct(F.array_compact(F.transform("tests", key)))


def _offered() -> Column:
    """Every key that a rule which covers one with these ``tests`` can ask for; ``*`` if it asks for none."""

    def keys(t: Column) -> Column:
        parts = F.split(t["text"], "/")
        above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
        above = F.when(t["name"].isin("dir", "path") & (t["op"] == "="), F.concat(above, F.array(F.when(t["text"].startswith("/"), F.lit("/")))))
        folders = F.transform(F.coalesce(above, F.array(F.when(t["name"] == "dir", t["text"]))), lambda d: F.concat(F.lit("d:"), d))
        return F.concat(folders, F.array(F.concat(F.lit("e:"), t["name"], t["op"], t["text"])))

    return F.array_distinct(F.array_append(F.array_compact(F.flatten(F.transform("tests", keys))), F.lit("*")))


def covered_rules(rules: DataFrame) -> DataFrame:
    """(ruleset, idx, covered_by): rules that can never decide an event, and the first rule that covers each.

    A rule covers a later one of its set if it is probed wherever the other is
    and each of its tests follows from a test of the other: an equal one, a
    wider interval, set or folder.  Rules that hold never
    (``unsupported_rules``) cover nothing.

    Rules of a set with the same probes and tests are one class: what covers one
    covers all, and the first of a class stands for it.  Classes meet in an equi
    join of a probe and the key of the test that fewest classes ask for; only
    classes whose tests are all intervals or sets of access, or that have no
    test, meet every class of their probe.
    """
    base = work_dir(rules.sparkSession, "rules")
    probes, tests = _probes_and_tests()
    own = rules.filter(F.col("kind").isin("watch", "syscall") & F.col("ruleset").isNotNull() & F.col("idx").isNotNull()).select(
        "ruleset", "idx", (F.size(_unsupported_tests()) == 0).alias("able"),
        F.when(_on_exit_list(), F.struct(F.sort_array(F.array_distinct(probes)).alias("probes"), tests.alias("tests"))).alias("_form"),
    )
    # Parsed once; what is shuffled for each rule is a digest of its form.
    own.withColumn("form", F.when(F.size("_form.probes") > 0, F.md5(F.to_json("_form")))).write.parquet(f"{base}/own")
    own = rules.sparkSession.read.parquet(f"{base}/own")
    forms = own.filter(F.col("form").isNotNull()).groupBy("form").agg(F.first("_form").alias("_form")).select("form", "_form.*")
    # Rows of one number are one rule.
    rule = own.groupBy("ruleset", "idx").agg(F.min("able").alias("able"), F.sort_array(F.collect_set("form")).alias("forms")).filter(F.size("forms") > 0)
    rule = rule.select("ruleset", "idx", F.concat_ws(",", F.col("able").cast("string"), "forms").alias("class"))
    classes = rule.groupBy("ruleset", "class").agg(F.min("idx").alias("first"))
    parts = classes.select("ruleset", "class", "first", F.explode(F.slice(F.split("class", ","), 2, 1_000_000)).alias("form")).join(forms, "form")
    parts = parts.select("ruleset", "class", "first", F.explode("probes").alias("probe"), "tests").distinct()
    # A part is one probe of a class with its tests.
    parts.withColumn("part", F.md5(F.to_json(F.struct("class", "probe", "tests")))).write.parquet(f"{base}/parts")
    parts = rules.sparkSession.read.parquet(f"{base}/parts")

    able = parts.filter(F.col("class").startswith("true"))
    asks = able.select("ruleset", "probe", "part", F.explode_outer(_asked()).alias("ask"))
    asked = asks.filter(F.col("ask").isNotNull()).groupBy("ruleset", "probe", "ask").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min(F.struct("n", "ask"))["ask"]
    wide = asks.join(asked, ["ruleset", "probe", "ask"], "left").groupBy("ruleset", "probe", "part").agg(F.coalesce(rarest, F.lit("*")).alias("ask"))
    narrow = parts.select("ruleset", F.explode(_wider_probes()).alias("probe"), F.col("part").alias("own"), "tests")
    narrow = narrow.select("ruleset", "probe", "own", F.explode(_offered()).alias("ask"))
    pairs = narrow.join(wide, ["ruleset", "probe", "ask"]).select("ruleset", "own", "part").distinct()

    theirs = parts.select("ruleset", F.col("part").alias("own"), F.col("class").alias("_class"), F.col("probe").alias("_probe"), F.col("tests").alias("theirs"))
    pairs = pairs.join(theirs, ["ruleset", "own"]).join(parts.select("ruleset", "part", "class", "first", "tests"), ["ruleset", "part"])
    follows = F.forall("tests", lambda a: F.exists("theirs", lambda b: _implied(a, b)))
    whole = pairs.filter(follows).groupBy("ruleset", "_class", "class", "first").agg(F.countDistinct("_probe").alias("n"))
    n = parts.groupBy("ruleset", F.col("class").alias("_class")).agg(F.count(F.lit(1)).alias("n"))
    # The first rule of all covering classes, the own one among them, covers every later rule of the class.
    best = whole.join(n, ["ruleset", "_class", "n"]).groupBy("ruleset", F.col("_class").alias("class")).agg(F.min("first").alias("covered_by"))
    return rule.join(best, ["ruleset", "class"]).filter(F.col("covered_by") < F.col("idx")).select("ruleset", "idx", "covered_by")
