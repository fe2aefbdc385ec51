"""The main text functions under SQL names, and a hook for line functions in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_RECORD_TYPE = r"regexp_extract(line, 'type=(\\w+)', 1)"
_RESULT = (
    "CASE WHEN contains(line, 'res=success') OR contains(line, 'success=yes') "
    "THEN 'success' ELSE 'failed' END"
)
# Arguments sorted by (index length, index); the first of each index is kept.
_COMMAND = r"""
CASE WHEN contains(line, 'type=EXECVE') THEN transform(
  transform(array(array_sort(concat(
    transform(regexp_extract_all(line, 'a(\\d+)="([^"]*)"', 0), (t, i) -> struct(
      length(ltrim('a0', substring_index(t, '=', 1))) AS width, ltrim('a0', substring_index(t, '=', 1)) AS digits,
      0 AS source, -i AS place, substring(t, instr(t, '"') + 1, length(t) - instr(t, '"') - 1) AS val)),
    transform(
      filter(regexp_extract_all(line, 'a\\d+=([0-9A-Fa-f]+)', 0), t -> length(substring_index(t, '=', -1)) % 2 = 0),
      (t, i) -> struct(
      length(ltrim('a0', substring_index(t, '=', 1))) AS width, ltrim('a0', substring_index(t, '=', 1)) AS digits,
      1 AS source, i AS place, make_valid_utf8(CAST(unhex(substring_index(t, '=', -1)) AS STRING)) AS val))))),
    s -> filter(s, (e, i) -> NOT (e.digits <=> get(s, i - 1).digits))),
  a -> CASE WHEN size(a) > 0 THEN array_join(transform(a, e -> e.val), ' ') END)[0] END"""


def register_functions(spark: SparkSession) -> None:
    """Make ``audit_record_type``, ``audit_result`` and ``execve_command`` usable in SQL.

    They are SQL functions, so the optimizer sees their bodies: no UDF runs.
    """
    bodies = {
        "audit_record_type": _RECORD_TYPE,
        "audit_result": _RESULT,
        "execve_command": _COMMAND,
    }
    for name, body in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(line STRING) RETURNS STRING RETURN {body}"
        )


def map_lines(
    df: DataFrame, parse: Callable[[str], str | None], column: str = "value"
) -> DataFrame:
    """Run a Python line function over a column, one Arrow batch at a time.

    For parsers that only exist in Python; the built-in operators do not need
    it.  A line for which ``parse`` returns None is dropped; a line it fails
    on passes unchanged.
    """

    def one(line: str | None) -> str | None:
        try:
            return parse(line)
        except Exception:
            return line

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame.assign(**{column: [one(v) for v in frame[column]]})
            yield out[out[column].notna()]

    return df.mapInPandas(batches, df.schema)
