"""The whole line job: parse, route, enrich, render."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.operators.enrich import enrich_execve
from logforge.operators.routing import route
from logforge.sources.logs import parse_syslog


def process_lines(
    df: DataFrame,
    line: str = "value",
    profile: str = "debian",
    mode: str = "compat",
    passwd: DataFrame | None = None,
    groups: DataFrame | None = None,
    keep: tuple[str, ...] = ("FORWARD",),
    year: int | None = None,
) -> DataFrame:
    """Raw syslog lines to routed, enriched rows.

    Adds the syslog columns, ``route``, ``cmd``, ids and names, ``techniques``,
    ``mitre_techniques`` and ``line_out``; only routes in ``keep`` stay.  The
    raw text stays in its own column, so both outputs (raw and enriched) come
    from one pass.
    """
    routed = route(parse_syslog(df, line, year), profile)
    kept = routed.filter(F.col("route").isin(*keep))
    return enrich_execve(kept, "msg", mode, profile, passwd, groups)
