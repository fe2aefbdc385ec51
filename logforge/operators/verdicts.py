"""One verdict per record from the exclude, user and exit lists of a rule set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.functions.audit import id_value
from logforge.operators import rule_match as M
from logforge.operators.events import EVENT_KEY, raw_fields
from logforge.scale import left_lookup

# Records that describe a system call: the exit list decides for them.
CALL_RECORDS = (
    "SYSCALL", "PATH", "CWD", "EXECVE", "PROCTITLE", "SOCKADDR", "SOCKETCALL", "IPC", "MMAP", "FD_PAIR", "BPRM_FCAPS", "CAPSET", "OBJ_PID",
)
# Records that programs write, beside those whose name begins with USER.
_FROM_PROGRAMS = (
    "CRED_ACQ", "CRED_DISP", "CRED_REFR", "ADD_USER", "DEL_USER", "ADD_GROUP", "DEL_GROUP", "CHUSER_ID", "CHGRP_ID", "GRP_AUTH",
    "ACCT_LOCK", "ACCT_UNLOCK", "ROLE_ASSIGN", "ROLE_REMOVE", "SERVICE_START", "SERVICE_STOP", "SYSTEM_BOOT", "SYSTEM_SHUTDOWN", "SYSTEM_RUNLEVEL",
)


def from_program(record_type: Column) -> Column:
    return record_type.startswith("USER") | record_type.isin(*_FROM_PROGRAMS)


def _type_rules(rules: DataFrame, where: str) -> DataFrame:
    """Rules of a list by the record type they name (``*`` for any): one row a type, its rules in order.

    A rule that asks for two types at once holds never.
    """
    msgtype = lambda op: F.transform(F.filter("fields", lambda f: (f["name"] == "msgtype") & (f["op"] == op)), lambda f: f["value"])
    others = F.filter("fields", lambda f: f["name"] != "msgtype")
    own = rules.filter((F.col("list") == where) & (F.col("kind") == "syscall")).select(
        F.array_distinct(msgtype("=")).alias("_types"), "idx",
        F.struct("idx", "action", M._typed_fields(others).alias("tests"), msgtype("!=").alias("but")).alias("_rule"),
    )
    named = own.filter(F.size("_types") <= 1).withColumn("probe", F.coalesce(F.get("_types", F.lit(0)), F.lit("*")))
    return named.groupBy("probe").agg(F.sort_array(F.collect_list(F.struct("idx", "_rule"))).alias("_in_order")).select(
        "probe", F.transform("_in_order", lambda r: r["_rule"]).alias(f"_{where}")
    )


def _first_hit(df: DataFrame, rules: DataFrame, where: str) -> DataFrame:
    """Add ``_hit``: the first rule of the list that holds for the record (NULL if none)."""
    known = _type_rules(rules, where).withColumnRenamed(f"_{where}", "_rules")
    named = known.filter("probe != '*'").select(F.col("probe").alias("record_type"), F.col("_rules").alias("_named"))
    every = known.filter("probe = '*'").select(F.col("probe").alias("_every"), "_rules")
    # Always "*", but taken from the row: over a bare constant the lookup of one row is planned as a nested loop.
    any_type = F.left(F.concat(F.lit("*"), F.coalesce("record_type", F.lit(""))), F.lit(1))
    df = left_lookup(left_lookup(df, named, ["record_type"]).withColumn("_every", any_type), every, ["_every"])

    def holds(rule: Column) -> Column:
        return F.forall(rule["tests"], M._holds) & ~F.coalesce(F.array_contains(rule["but"], F.col("record_type")), F.lit(False))

    a, b = (F.get(F.filter(c, holds), F.lit(0)) for c in ("_named", "_rules"))
    return df.withColumn("_hit", F.when(b.isNull() | (a["idx"] < b["idx"]), a).otherwise(b)).drop("_named", "_rules", "_every")


def _attributes() -> list[Column]:
    """What rules of the exclude and user lists test, from the record itself; fields of calls are NULL."""
    raw = F.col("_raw")
    return [
        *[id_value(raw[n]).alias(n) for n in M._IDS], F.when(raw["exe"] != "", raw["exe"]).alias("exe"), F.get(F.split(raw["subj"], ":"), F.lit(2)).alias("subj_type"),
        *[F.lit(None).cast("bigint").alias(n) for n in ("exit", "success", "a0", "a1", "a2", "a3", "access")], F.lit(None).cast("string").alias("path"),
    ]


def record_verdicts(records: DataFrame, rules: DataFrame, line: str = "msg") -> DataFrame:
    """The records with ``list`` and ``idx`` of the rule that decides each, and ``kept``.

    The exclude list comes first: a record that one of its rules names goes,
    whatever the action.  Records that programs write are kept unless the first
    user rule that holds says never.  Records of a system call are kept if the
    first exit rule that holds for their event says always, and go if it says
    never or none holds; all records of an event share that.  A record of a call
    whose SYSCALL record is missing cannot be judged and is kept, as are all
    other records and lines without a header; ``list`` and ``idx`` are NULL where no
    rule decides.  ``rules`` is one rule set.  Columns of the records named as
    the new ones are replaced.
    """
    if rules.select("ruleset").distinct().count() > 1:
        raise ValueError("one rule set at a time")
    keep = [c for c in records.columns if c not in ("list", "idx", "kept")]
    calls = M.normalize_events(records.select(*EVENT_KEY, "record_type", line), line)
    first = M.first_rules(M.match_rules(calls, rules)).select(*EVENT_KEY, F.col("idx").alias("_idx"), F.col("action").alias("_action"))
    judged = calls.select(*EVENT_KEY).distinct().withColumn("_judged", F.lit(True)).join(first, EVENT_KEY, "left")

    rows = records.select(F.struct(*keep).alias("_row"), *EVENT_KEY, "record_type", raw_fields(line, (*M._IDS, "exe", "subj")).alias("_raw"))
    rows = rows.select("_row", *EVENT_KEY, "record_type", *_attributes())
    rows = _first_hit(rows, rules, "exclude").withColumnRenamed("_hit", "_out")
    rows = _first_hit(rows, rules, "user").select("_row", *EVENT_KEY, "record_type", F.col("_out.idx").alias("_out"), "_hit")
    kind, out = F.col("record_type"), F.col("_out")
    of_call = F.coalesce(out.isNull() & kind.isin(*CALL_RECORDS), F.lit(False))

    told = F.coalesce(out.isNull() & from_program(kind), F.lit(False)) & F.col("_hit").isNotNull()
    alone = rows.filter(~of_call).select(
        "_row.*", F.when(out.isNotNull(), "exclude").when(told, "user").alias("list"),
        F.when(out.isNotNull(), out).when(told, F.col("_hit.idx")).alias("idx"),
        (out.isNull() & ~(told & F.coalesce(F.col("_hit.action") == "never", F.lit(False)))).alias("kept"),
    )
    action = F.coalesce("_action", F.lit("never"))
    together = rows.filter(of_call).select("_row", *EVENT_KEY).join(judged, EVENT_KEY, "left").select(
        "_row.*", F.when(F.col("_idx").isNotNull(), "exit").alias("list"), F.col("_idx").alias("idx"),
        (F.col("_judged").isNull() | (action == "always")).alias("kept"),
    )
    return alone.unionByName(together)
