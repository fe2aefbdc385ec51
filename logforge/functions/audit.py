"""Audit record fields: type, result, header, key=value pairs, fixed shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logforge.facts import UNSET_ID
from logforge.functions.text import capture, col, first_group, let

_HEADER = r"audit\((\d+(?:\.\d+)?:\d+)\)"


def record_type(line: Column | str, mode: str = "first") -> Column:
    """Record type of a line.

    ``first``: word after the first ``type=``, '' if there is none.
    ``fallback``: upper-case letters and underscores only, default UNKNOWN.
    """
    if mode == "first":
        return F.regexp_extract(col(line), r"type=(\w+)", 1)
    if mode == "fallback":
        return F.coalesce(first_group(line, r"type=([A-Z_]+)"), F.lit("UNKNOWN"))
    raise ValueError(f"unknown mode {mode!r}")


def audit_result(line: Column | str) -> Column:
    """``success`` if the line says so, else ``failed`` (also without any result)."""
    line = col(line)
    good = F.contains(line, F.lit("res=success")) | F.contains(line, F.lit("success=yes"))
    return F.when(good, F.lit("success")).otherwise(F.lit("failed"))


def is_execve(line: Column | str) -> Column:
    return F.contains(col(line), F.lit("type=EXECVE"))


# Extracted field, value pattern, default.
FIELDS = (
    ("auid", r"auid=([0-9-]+)", "-1"),
    ("uid", r"uid=([0-9]+)", "-1"),
    ("euid", r"euid=([0-9]+)", "-1"),
    ("pid", r"pid=([0-9]+)", "-1"),
    ("exe", r'exe="([^"]+)"', "unknown"),
    ("success", r"success=([a-z]+)", "unknown"),
    ("key", r'key="([^"]+)"', "none"),
)


def field_columns(line: Column | str, mode: str = "compat") -> dict[str, Column]:
    """The eight forwarded fields with defaults.

    ``compat`` searches unanchored, so ``uid=`` also hits inside ``auid=``;
    ``strict`` asks for a word boundary before the name.
    """
    if mode not in ("compat", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    edge = r"\b" if mode == "strict" else ""
    out = {"audit_type": record_type(line, "fallback")}
    for name, pattern, default in FIELDS:
        out[name] = F.coalesce(first_group(line, edge + pattern), F.lit(default))
    return out


def audit_header(line: Column | str) -> Column:
    """Text ``SEC[.MS]:SERIAL`` of the audit header, NULL if there is none."""
    return first_group(line, _HEADER)


def header_fields(inner: Column) -> dict[str, Column]:
    """epoch_ms and serial of a header text; the fraction is optional."""
    stamp = F.substring_index(inner, ":", 1)
    seconds = F.substring_index(stamp, ".", 1).try_cast("bigint")
    fraction = F.rpad(F.substring_index(stamp, ".", -1), 3, "0").substr(1, 3).try_cast("bigint")
    millis = F.when(F.contains(stamp, F.lit(".")), fraction).otherwise(F.lit(0))
    return {
        "epoch_ms": seconds * 1000 + millis,
        "serial": F.substring_index(inner, ":", -1).try_cast("bigint"),
    }


def id_value(text: Column) -> Column:
    """Numeric id as BIGINT; the three spellings of "not set" become NULL.

    The text is used several times: extract it in a projection of its own.
    """
    # A failed cast costs far more than the test for an absent ('') value.
    number = F.when(text != "", text.try_cast("bigint"))
    return F.when((number != UNSET_ID) & (number != -1), number)


def is_unset(text: Column | str) -> Column:
    """True for 4294967295, -1, 'unset' and for values that are no number."""
    return id_value(col(text).cast("string")).isNull()


def auid_is_user(text: Column | str) -> Column:
    """Login id of a person: at least 1000 and set."""
    return F.coalesce(id_value(col(text).cast("string")) >= 1000, F.lit(False))


# Fields whose text comes from outside: audit writes them in hex if they hold a blank, a quote or a control byte.
UNTRUSTED = frozenset(("name", "comm", "exe", "cwd", "acct", "key", "dir", "proctitle"))


def field_value(line: Column | str, name: str) -> Column:
    """Value of ``name=`` at a word boundary, NULL if absent, empty or ``(null)``.

    A quoted value is read whole, blanks included.  An unquoted one ends at a
    blank or at byte 0x1D, where enriched names begin; if it is hex in a field
    of ``UNTRUSTED`` it is decoded.
    """
    value = first_group(
        line, rf'\b{name}=(?:"|)((?<=")[^"]+|(?<!")(?!\(null\)(?:[\s\x1d]|$))[^"\s\x1d]+)'
    )
    if name not in UNTRUSTED:
        return value
    digits = first_group(line, rf"\b{name}=((?:[0-9A-F]{{2}})+)(?:[\s\x1d]|$)")
    # File names are arbitrary bytes: bad UTF-8 becomes U+FFFD instead of ending the job.
    return F.coalesce(F.make_valid_utf8(F.unhex(digits).cast("string")), value)


def event_result(line: Column | str) -> Column:
    """1 if the record tells of a failure, 0 if of a success, NULL if it has no result."""
    found = first_group(line, r"\b(?:success|res)=(\w+)")
    return F.when(found.isin("yes", "success", "1"), 0).when(found.isNotNull(), 1)


def technique_of_key(key: Column | str) -> Column:
    """Leading ``T`` and four digits of a rule key, NULL if it names none."""
    return first_group(key, r"^(T\d{4})")


# A token is name=value; values may be quoted; enriched names follow 0x1D.
_TOKEN = r"""(?:^|[\s\x1d'])([A-Za-z_][\w-]*(?:\[\d+\])?)=("[^"]*"|[^\s'\x1d"]*)"""


def kv_tokens(line: Column | str) -> Column:
    """ARRAY of (name, value) tokens in line order, the value unquoted."""
    return F.transform(
        F.regexp_extract_all(col(line), F.lit(_TOKEN), F.lit(0)),
        lambda t: F.struct(
            F.ltrim(F.substring_index(t, "=", 1), F.lit(" \t\n\x0b\x0c\r\x1d'")).alias("name"),
            F.btrim(F.substring(t, F.instr(t, "=") + 1, F.length(t)), F.lit('"')).alias("value"),
        ),
    )


def _first_values(tokens: Column) -> Column:
    """Tokens with the first value of every name, by sorting and comparing neighbours."""
    entries = F.sort_array(
        F.transform(tokens, lambda t, i: F.struct(t["name"].alias("name"), i.alias("at"), t["value"].alias("value")))
    )
    firsts = let(
        entries,
        lambda s: F.filter(s, lambda e, i: ~e["name"].eqNullSafe(F.get(s, i - 1)["name"])),
    )
    return F.transform(firsts, lambda e: F.struct(e["name"].alias("name"), e["value"].alias("value")))


def kv_map(line: Column | str) -> Column:
    """MAP of the tokens; the first value of a repeated name is kept."""
    names = lambda t: F.transform(t, lambda x: x["name"])
    return let(
        kv_tokens(line),
        lambda t: F.map_from_entries(
            F.when(F.size(F.array_distinct(names(t))) == F.size(t), t).otherwise(_first_values(t))
        ),
    )


# --- fixed values: field layout of four record shapes ------------------------
# Name and kind; kinds: word, number, ipv4, text (inside double quotes), command.
_COMMON = (("pid", "number"), ("uid", "number"), ("auid", "number"), ("ses", "number"))
_NUMBERS = lambda names: tuple((n, "number") for n in names.split())
SHAPES = {
    "USER_AUTH": (
        _COMMON,
        (
            ("op", "word"), ("acct", "text"), ("exe", "text"), ("hostname", "word"),
            ("addr", "ipv4"), ("terminal", "word"), ("res", "word"),
        ),
    ),
    "USER_CMD": (
        _COMMON,
        (("cwd", "text"), ("cmd", "command"), ("terminal", "word"), ("res", "word")),
    ),
    "SYSCALL": (
        (
            ("arch", "word"), ("syscall", "number"), ("success", "word"),
            ("exit", "number"), ("a0", "word"), ("a1", "word"), ("a2", "word"),
            ("a3", "word"),
        )
        + _NUMBERS(
            "items ppid pid auid uid gid euid suid fsuid egid sgid fsgid"
        )
        + (
            ("tty", "word"), ("ses", "number"), ("comm", "text"), ("exe", "text"),
            ("key", "text"),
        ),
        (),
    ),
    "EXECVE": (
        (("argc", "number"), ("a0", "text"), ("a1", "text"), ("a2", "text"), ("a3", "text")),
        (),
    ),
}
_KINDS = {
    "word": r"([^\s'\x01]+)",
    "number": r"(-?\d+)",
    "ipv4": r"(\d{1,3}(?:\.\d{1,3}){3})",
    "text": r'"([^"\x01]*)"',
    "command": r'("[^"\x01]*"|[^\s\x01]+)',
}


def shape_pattern(shape: str) -> tuple[str, list[tuple[str, str]]]:
    """Regex of a shape and its fields (name, kind) in group order."""
    outer, inner = SHAPES[shape]
    part = lambda fields: " ".join(f"{n}={_KINDS[k]}" for n, k in fields)
    pattern = r"^type=([^\s\x01]+) msg=audit\((\d+)(?:\.\d+)?:(\d+)\): " + part(outer)
    if inner:
        pattern += " msg='" + part(inner) + "'"
    head = [("type", "word"), ("audit_epoch", "number"), ("audit_counter", "number")]
    return pattern + r"[\s\S]*$", head + list(outer) + list(inner)


def shape_struct(line: Column | str, shape: str) -> Column:
    """Typed fields of a record shape as a struct, NULL where it does not match."""
    pattern, fields = shape_pattern(shape)
    parts = capture(line, pattern, len(fields))

    def build(p: Column) -> Column:
        values = []
        for i, (name, kind) in enumerate(fields):
            value = F.get(p, F.lit(i))
            value = value.try_cast("bigint") if kind == "number" else value
            values.append(value.alias(name))
        return F.when(p.isNotNull(), F.struct(*values))

    return let(parts, build)
