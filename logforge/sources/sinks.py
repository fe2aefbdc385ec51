"""Writers for rendered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_lines(
    df: DataFrame, path: str, column: str = "line_out", by: str | None = None,
    compression: str | None = None,
) -> None:
    """Write one text line per row; ``by`` makes one folder per value (a sink, a format).

    The rows are written where they are: no shuffle, one file per task and folder.
    """
    rows = df.select(F.col(column).alias("value"), *([by] if by else []))
    writer = rows.write.mode("append")
    if by:
        writer = writer.partitionBy(by)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def write_events(df: DataFrame, path: str, by: tuple[str, ...] = ("record_type",)) -> None:
    """Write typed rows as Parquet folders, so that later filters prune whole folders."""
    df.write.mode("append").partitionBy(*by).parquet(path)
