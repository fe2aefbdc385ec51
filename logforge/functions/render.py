"""Delivery formats of one message as text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logforge.functions.syslog import priority
from logforge.functions.text import col


def utc_text(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss.ffffff`` in UTC, whatever the session zone."""
    since = F.unix_micros(col(ts)) * F.expr("INTERVAL '0.000001' SECOND")
    return (F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + since).cast("string")


def rfc3339_time(ts: Column | str, session_zone: bool = False) -> Column:
    """RFC 3339 time to the millisecond, in UTC unless the session zone is asked for."""
    if session_zone:
        return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    text = utc_text(ts)
    millis = F.lpad(F.pmod(F.unix_millis(col(ts)), F.lit(1000)).cast("string"), 3, "0")
    return F.concat(
        F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), millis,
        F.lit("Z"),
    )


def traditional_time(ts: Column | str, session_zone: bool = False) -> Column:
    """``Mon dd HH:MM:SS`` with the day padded by a blank."""
    ts = col(ts)
    if session_zone:
        return F.concat(
            F.date_format(ts, "MMM "),
            F.lpad(F.dayofmonth(ts).cast("string"), 2, " "),
            F.date_format(ts, " HH:mm:ss"),
        )
    text = utc_text(ts)
    date = F.substring(text, 1, 10).cast("date")
    return F.concat(
        F.monthname(date), F.lit(" "), F.lpad(F.dayofmonth(date).cast("string"), 2, " "),
        F.lit(" "), F.substring(text, 12, 8),
    )


def _known(value: Column | str, stand_in: str = "-") -> Column:
    """A line is never lost for a part it lacks: a dash stands for it."""
    return F.coalesce(col(value), F.lit(stand_in))


def rfc3339(ts="ts", host="host", facility="facility", severity="severity",
            program="program", msg="msg") -> Column:
    """``<PRI>TIME HOST APP: MSG``; a line without priority has 13, user.notice."""
    return F.concat(
        F.lit("<"), _known(priority(facility, severity).cast("string"), "13"), F.lit(">"),
        _known(rfc3339_time(ts)), F.lit(" "), _known(host), F.lit(" "), _known(program), F.lit(": "),
        _known(msg, ""),
    )


def received(ts="ts", host="host", tag="program", msg="msg") -> Column:
    """``TIME HOST TAG MSG`` as the receiver writes it."""
    return F.concat_ws(" ", _known(rfc3339_time(ts)), _known(host), _known(tag), _known(msg, ""))


def traditional(ts="ts", host="host", tag="program", msg="msg") -> Column:
    return F.concat(
        _known(traditional_time(ts)), F.lit(" "), _known(host), F.lit(" "), _known(tag), F.lit(": "),
        _known(msg, ""),
    )


def kv(line: Column, pairs: dict[str, Column], prefix: str = "") -> Column:
    """``line k="v" k="v"`` without escaping; NULL values are left out."""
    cells = [F.concat(F.lit(f'{k}="'), v, F.lit('"')) for k, v in pairs.items()]
    text = F.concat_ws(" ", line, *cells)
    return F.concat(F.lit(prefix), text) if prefix else text


_LEEF_ORDER = ("devTime", "auid", "uid", "euid", "pid", "exe", "success", "key", "cmd")


def _leef_escape(value: Column) -> Column:
    """Keep the separators out of values: backslash, tab, line break and bar are escaped."""
    for char, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\r\n", "\\n"), ("\n", "\\n"), ("|", "\\|")):
        value = F.replace(value, F.lit(char), F.lit(escaped))
    return value


def leef(event_id: Column, fields: dict[str, Column]) -> Column:
    """LEEF 2.0 line: header, then tab-joined fields in a fixed order."""
    cells = F.array(
        *[F.concat(F.lit(f"{n}="), fields[n].cast("string")) for n in _LEEF_ORDER if n in fields]
    )
    body = F.array_join(F.transform(cells, _leef_escape), "\t")
    return F.concat(F.lit("LEEF:2.0|Linux|auditd|1.0|"), event_id, F.lit("|"), body)


def octet_frame(line: Column | str) -> Column:
    """Prefix a line with its length in bytes (octet counting)."""
    line = col(line)
    return F.concat(F.octet_length(line).cast("string"), F.lit(" "), line)
