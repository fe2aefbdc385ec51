"""Noise and keep tests, ordered routing, selector files, lookup filter."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.facts import (
    EXCLUDED_TYPES,
    FACILITIES,
    KEEP_PROFILES,
    NOISE_PROFILES,
    NOISE_TEXTS,
    SECURITY_KEYWORDS,
    SELECTORS,
    SEVERITIES,
)
from logforge.functions.audit import is_execve, record_type
from logforge.functions.text import col
from logforge.scale import left_lookup


def _member(c: Column, values) -> Column:
    # NULL (an unparsed line) is in no set.
    return F.coalesce(c.isin(*values), F.lit(False)) if values else F.lit(False)


def _facility_in(facility: Column | str, names) -> Column:
    """Facility (a number) is one of the named ones."""
    return _member(col(facility), [FACILITIES.index(n) for n in names])


def is_noise(profile: str = "debian", program="program", facility="facility") -> Column:
    """True for programs and facilities the profile drops (case-sensitive)."""
    sets = NOISE_PROFILES[profile]
    program = col(program)
    noise = _member(program, sets["name"]) | _facility_in(facility, sets["facility"])
    for prefix in sets["prefix"]:
        noise = noise | F.coalesce(F.startswith(program, F.lit(prefix)), F.lit(False))
    return noise


def is_security(profile: str = "debian", program="program", facility="facility") -> Column:
    sets = KEEP_PROFILES[profile]
    return _member(col(program), sets["name"]) | _facility_in(facility, sets["facility"])


def route(df: DataFrame, profile: str = "debian") -> DataFrame:
    """Add ``route``: DROP, else FORWARD, else DEFAULT; the first test that holds wins."""
    return df.withColumn(
        "route",
        F.when(is_noise(profile), "DROP").when(is_security(profile), "FORWARD").otherwise("DEFAULT"),
    )


def forwarded(df: DataFrame, profile: str = "debian") -> DataFrame:
    """Only the rows that leave for the collector."""
    return df.filter(~is_noise(profile) & is_security(profile))


def split_outputs(df: DataFrame, profile: str = "debian") -> tuple[DataFrame, DataFrame]:
    """Forwarded rows, and the copy of their EXECVE rows that gets enriched."""
    raw = forwarded(df, profile)
    return raw, raw.filter(is_execve("msg"))


def drop_proctitle(df: DataFrame, line: str = "msg") -> DataFrame:
    """Leave out EXECVE lines that carry a process title (manual profile)."""
    titled = F.contains(F.col(line), F.lit("proctitle=")) | F.contains(
        F.col(line), F.lit("PROCTITLE")
    )
    return df.filter(~(is_execve(line) & titled))


def apply_lookup(
    df: DataFrame, lookup: DataFrame, key: str = "program", nomatch: str = "PASS"
) -> DataFrame:
    """Add ``action`` from a lookup table, ``nomatch`` where it has no entry."""
    # One entry per program, so a repeated entry cannot multiply rows.
    dim = lookup.groupBy(F.col("program").alias(key)).agg(F.min("action").alias("action"))
    joined = left_lookup(df, dim, [key])
    return joined.withColumn("action", F.coalesce("action", F.lit(nomatch)))


def drop_ignored(df: DataFrame, lookup: DataFrame, key: str = "program") -> DataFrame:
    """Leave out the rows whose program the lookup table ignores."""
    ignored = lookup.filter(F.col("action") == "IGNORE").select(F.col("program").alias(key))
    return left_lookup(df, ignored, [key], how="left_anti")


def exclude_types(df: DataFrame, types=EXCLUDED_TYPES, line: str = "msg") -> DataFrame:
    """Leave out audit records of the given types."""
    kind = F.col("record_type") if "record_type" in df.columns else record_type(line)
    return df.filter(~kind.isin(*types))


def any_word(text: Column | str, words, ignore_case: bool = True) -> Column:
    """True if the text holds one of the words (literally)."""
    pattern = "|".join(re.escape(w) for w in words)
    return col(text).rlike(("(?i)" if ignore_case else "") + f"(?:{pattern})")


def keep_keywords(df: DataFrame, words=SECURITY_KEYWORDS, text: str = "msg") -> DataFrame:
    """Only the rows whose message holds a security keyword."""
    return df.filter(any_word(text, words))


def drop_text(df: DataFrame, texts=NOISE_TEXTS, text: str = "msg") -> DataFrame:
    """Leave out rows with an operational message text."""
    return df.filter(~F.coalesce(any_word(text, texts), F.lit(False)))


def selector_test(selector: str, facility: Column, severity: Column) -> Column:
    """Meaning of one selector: ``fac[,fac].sev`` parts joined by ``;``.

    A severity means "this or more urgent", ``*`` any, and ``none`` takes the
    facilities out again.  A selector of ``none`` parts only selects nothing.
    """
    chosen = F.lit(False)
    for part in selector.split(";"):
        names, level = part.rsplit(".", 1)
        here = F.lit(True) if names == "*" else _facility_in(facility, names.split(","))
        if level == "none":
            chosen = chosen & ~here
        elif level == "*":
            chosen = chosen | here
        else:
            chosen = chosen | (here & (severity <= SEVERITIES.index(level)))
    return chosen


def route_selectors(
    df: DataFrame, selectors=SELECTORS, local_copy: str | None = None
) -> DataFrame:
    """One row per message and sink that selects it (``sink`` column).

    ``local_copy`` names an extra sink that gets everything of facility local3.
    """
    rules = list(selectors)
    if local_copy:
        rules.append(("local3.*", local_copy))
    tests = [
        F.when(selector_test(sel, F.col("facility"), F.col("severity")), F.lit(sink))
        for sel, sink in rules
    ]
    sinks = F.array_distinct(F.array_compact(F.array(*tests)))
    return df.withColumn("sink", F.explode(sinks))
