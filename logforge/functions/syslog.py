"""Syslog message parts: priority, facility, severity, header and tag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logforge.facts import FACILITIES, SEVERITIES
from logforge.functions.text import col

_PRI = r"(?:<(\d{1,3})>)?"
_RFC3339 = r"\d{4}-\d\d-\d\dT[^\s\x01]+"
_TRADITIONAL = r"[A-Z][a-z]{2} [ \d]\d \d\d:\d\d:\d\d"
_TAG = r"([^\s:\[/\x01]+)((?:/[^\s:\[\x01]*)?)(?:\[(\d+)\])?"
HEADER = rf"(?s)^{_PRI}({_RFC3339}|{_TRADITIONAL}) ([^\s\x01]+) {_TAG}:? ?(.*)$"
# The same header when it is exactly three words: time, host, tag.
SHORT_HEADER = rf"^{_PRI}({_RFC3339}) ([^\s\x01]+) {_TAG}:?$"


def facility_of(pri: Column) -> Column:
    return F.floor(pri / 8).cast("int")


def severity_of(pri: Column) -> Column:
    return F.pmod(pri, F.lit(8)).cast("int")


def facility_text(facility: Column | str) -> Column:
    """Facility number to name; NULL outside the table."""
    names = F.array(*[F.lit(n) for n in FACILITIES])
    return F.get(names, col(facility).cast("int"))


def severity_text(severity: Column | str) -> Column:
    names = F.array(*[F.lit(n) for n in SEVERITIES])
    return F.get(names, col(severity).cast("int"))


def priority(facility: Column | str, severity: Column | str) -> Column:
    return col(facility) * 8 + col(severity)


def facility_number(name: Column | str) -> Column:
    """Facility name to number; NULL for an unknown name."""
    names = F.array(*[F.lit(n) for n in FACILITIES])
    pos = F.array_position(names, col(name)).cast("int")
    return F.when(pos > 0, pos - 1)


def header_words(line: Column | str) -> Column:
    """The first three words of a line: time, host and tag in most lines."""
    return F.substring_index(col(line), " ", 3)


def is_short(head: Column, line: Column) -> Column:
    """Is the header exactly those three words?"""
    return (F.length(head) < F.length(line)) & head.rlike(SHORT_HEADER)


def short_fields(head: Column, line: Column) -> dict[str, Column]:
    """Header fields of a short header, cut by position and separator."""
    word = lambda n: F.substring_index(F.substring_index(head, " ", n), " ", -1)
    tag = word(3)
    return {
        "pri": F.when(F.startswith(head, F.lit("<")), F.substring_index(F.substring(head, 2, 4), ">", 1)),
        "time": F.substring_index(word(1), ">", -1),
        "host": word(2),
        "program": F.substring_index(
            F.substring_index(F.substring_index(tag, ":", 1), "[", 1), "/", 1
        ),
        "pid": F.when(
            F.contains(tag, F.lit("[")),
            F.substring_index(F.substring_index(tag, "[", -1), "]", 1),
        ),
        "msg": F.substring(line, F.length(head) + 2, F.length(line)),
    }


def long_fields(parts: Column) -> dict[str, Column]:
    """The same from the groups of the whole header pattern (NULL without a match)."""
    part = lambda i: F.get(parts, F.lit(i))
    filled = lambda i: F.when(part(i) != "", part(i))
    return {
        "pri": filled(0), "time": part(1), "host": part(2), "program": part(3),
        "pid": filled(5), "msg": part(6),
    }


def syslog_time(text: Column, year: int | None = None) -> Column:
    """RFC 3339 or traditional time text to TIMESTAMP.

    Traditional stamps carry no year: pass the year the file was written in.
    """
    rfc = F.try_to_timestamp(text)
    if year is None:
        return rfc
    padded = F.concat(F.lit(f"{year} "), F.regexp_replace(text, r"^(\w{3})  ", "$1 0"))
    return F.when(text.rlike(r"^\d{4}-"), rfc).otherwise(
        F.try_to_timestamp(padded, F.lit("yyyy MMM dd HH:mm:ss"))
    )
