"""Lookup tables and identity dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logforge.facts import IGNORED_PROGRAMS

_LOOKUP_SCHEMA = (
    "version INT, nomatch STRING, type STRING, table ARRAY<STRUCT<index: STRING, value: STRING>>"
)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Lookup file (one JSON object with a ``table`` array) as program, action."""
    return (
        spark.read.schema(_LOOKUP_SCHEMA)
        .json(path, multiLine=True)
        .select(F.explode("table").alias("entry"))
        .select(F.col("entry.index").alias("program"), F.col("entry.value").alias("action"))
    )


def ignored_programs(spark: SparkSession) -> DataFrame:
    """The built-in lookup table."""
    return spark.createDataFrame(
        [(p, "IGNORE") for p in IGNORED_PROGRAMS], "program STRING, action STRING"
    )


def read_accounts(spark: SparkSession, path: str, host_from_path: str = r"([^/]+)/[^/]+$") -> DataFrame:
    """passwd or group files collected per host: host, id, name.

    The host is taken from the file path (by default the parent folder name).
    """
    parts = F.split("value", ":")
    return (
        spark.read.text(path)
        .select(
            F.regexp_extract(F.col("_metadata.file_path"), host_from_path, 1).alias("host"),
            F.get(parts, F.lit(2)).try_cast("bigint").alias("id"),
            F.get(parts, F.lit(0)).alias("name"),
        )
        .filter(F.col("id").isNotNull())
        .groupBy("host", "id")
        .agg(F.min("name").alias("name"))
    )
