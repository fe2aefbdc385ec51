"""Audit rule files as a DataFrame of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logforge.facts import NOT_SYSCALLS
from logforge.functions.audit import technique_of_key

RULE_SCHEMA = (
    "ruleset STRING, idx INT, kind STRING, list STRING, action STRING, path STRING, "
    "is_dir BOOLEAN, perm STRING, syscalls ARRAY<STRING>, "
    "fields ARRAY<STRUCT<name: STRING, op: STRING, value: STRING>>, key STRING, "
    "technique STRING"
)


def read_rule_lines(spark: SparkSession, path: str, ruleset: str | None = None) -> DataFrame:
    """Lines of rule files as ruleset, idx, value; ``idx`` is the line number.

    A rule file is small, so each is read as one text to keep its line order.
    Without ``ruleset`` the file name is taken.
    """
    name = F.lit(ruleset) if ruleset else F.regexp_extract("_metadata.file_name", r"^([^.]+)", 1)
    return (
        spark.read.text(path, wholetext=True)
        .select(name.alias("ruleset"), F.posexplode(F.split("value", r"\r?\n")).alias("idx", "value"))
    )


def read_rules(spark: SparkSession, path: str, ruleset: str | None = None) -> DataFrame:
    return parse_rules(read_rule_lines(spark, path, ruleset))


def _option(line: Column, letter: str) -> Column:
    return F.nullif(F.regexp_extract(line, rf"(?:^|\s)-{letter}\s+(\S+)", 1), F.lit(""))


def parse_rules(lines: DataFrame) -> DataFrame:
    """Rule lines (ruleset, idx, value) to rule rows.

    Blank lines and comments are left out; an ``-e`` control line sorts last.
    Both ``always,exit`` and ``exit,always`` are understood, repeated and
    comma-joined system calls as well; a watch without ``-p`` means ``rwxa``.
    """
    line = F.col("value")
    where = F.coalesce(_option(line, "a"), _option(line, "A"))
    halves = F.split(where, ",")
    actions = F.filter(halves, lambda p: p.isin("always", "never", "possible"))
    lists = F.filter(halves, lambda p: ~p.isin("always", "never", "possible"))
    raw_path = _option(line, "w")
    is_watch = raw_path.isNotNull()
    calls = F.flatten(
        F.transform(
            F.regexp_extract_all(line, F.lit(r"(?:^|\s)-S\s+(\S+)"), F.lit(1)),
            lambda s: F.split(s, ","),
        )
    )
    field_pattern = r"(?:^|\s)-[FC]\s+(\w+)(!=|>=|<=|&=|=|>|<|&)(\S+)"
    part = lambda i: F.regexp_extract_all(line, F.lit(field_pattern), F.lit(i))
    fields = F.transform(
        F.arrays_zip(part(1).alias("n"), part(2).alias("o"), part(3).alias("v")),
        lambda z: F.struct(z["n"].alias("name"), z["o"].alias("op"), z["v"].alias("value")),
    )
    keyed = F.filter(fields, lambda f: f["name"] == "key")
    key = F.coalesce(_option(line, "k"), F.get(keyed, F.lit(0))["value"])
    return (
        lines.filter(line.rlike(r"^\s*-"))
        .select(
            "ruleset",
            F.when(line.rlike(r"^\s*-e\b"), 1_000_000_000).otherwise(F.col("idx")).cast("int").alias("idx"),
            F.when(is_watch, "watch").when(where.isNotNull(), "syscall").otherwise("control").alias("kind"),
            F.when(is_watch, "exit").otherwise(F.get(lists, F.lit(0))).alias("list"),
            F.when(is_watch, "always").otherwise(F.get(actions, F.lit(0))).alias("action"),
            F.when(raw_path == "/", raw_path).otherwise(F.rtrim(raw_path, F.lit("/"))).alias("path"),
            F.when(is_watch, raw_path.endswith("/")).alias("is_dir"),
            F.when(is_watch, F.coalesce(_option(line, "p"), F.lit("rwxa"))).alias("perm"),
            calls.alias("syscalls"),
            F.filter(fields, lambda f: f["name"] != "key").alias("fields"),
            key.alias("key"),
        )
        .withColumn("technique", technique_of_key("key"))
    )


def builtin_rules(spark: SparkSession, *names: str) -> DataFrame:
    """Rule sets shipped with the package (see ``logforge.rulesets``)."""
    from logforge.rulesets import RULESETS, rule_rows

    rows = [r for n in (names or tuple(RULESETS)) for r in rule_rows(n)]
    return spark.createDataFrame(rows, RULE_SCHEMA.replace(", technique STRING", "")).withColumn(
        "technique", technique_of_key("key")
    )


def strict_rules(rules: DataFrame) -> DataFrame:
    """Rules without the known data defects.

    Account tools listed as system calls go (with the rule, if nothing else is
    left), as do glob watches, which match nothing, and exact repeats.
    """
    real = F.filter("syscalls", lambda s: ~s.isin(*NOT_SYSCALLS))
    kept = (
        rules.withColumn("_had", F.size("syscalls"))
        .withColumn("syscalls", real)
        .filter((F.col("_had") == 0) | (F.size("syscalls") > 0))
        .filter(F.coalesce(~F.contains(F.col("path"), F.lit("*")), F.lit(True)))
        .drop("_had")
    )
    same = [c for c in kept.columns if c != "idx"]
    return kept.groupBy(*same).agg(F.min("idx").alias("idx")).select(*kept.columns)


def rule_signature() -> Column:
    """One text per rule, independent of rule set and position."""
    fields = F.array_sort(
        F.transform("fields", lambda f: F.concat(f["name"], f["op"], f["value"]))
    )
    blank = F.lit("")
    return F.concat_ws(
        "|",
        "kind",
        F.coalesce("list", blank),
        F.coalesce("action", blank),
        F.coalesce("path", blank),
        F.coalesce(F.col("is_dir").cast("string"), blank),
        F.coalesce(F.array_join(F.array_sort(F.split("perm", "")), ""), blank),
        F.array_join(F.array_sort("syscalls"), ","),
        F.array_join(fields, ","),
        F.coalesce("key", blank),
    )


def ruleset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rules counted per side: signature, n_a, n_b, side (both, only_a, only_b).

    One aggregation over both sides; the sets never have to meet in a join.
    """
    one = lambda df, x, y: df.select(
        rule_signature().alias("signature"),
        F.lit(x).cast("bigint").alias("n_a"),
        F.lit(y).cast("bigint").alias("n_b"),
    )
    return (
        one(a, 1, 0)
        .unionAll(one(b, 0, 1))
        .groupBy("signature")
        .agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
        .withColumn(
            "side",
            F.when(F.col("n_b") == 0, "only_a").when(F.col("n_a") == 0, "only_b").otherwise("both"),
        )
    )
