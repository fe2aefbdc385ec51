"""Audit events: assembly of records, searches, duplicate and gap checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.functions import execve as X
from logforge.functions.audit import event_result, field_value, id_value, is_execve, technique_of_key

# Serial first: sorts of these keys then compare distinct numbers, not host names.
EVENT_KEY = ["serial", "epoch_ms", "host"]
_CALL_IDS = ("auid", "uid", "gid", "euid")
_CALL_TEXTS = ("arch", "syscall", "exit", "a0", "comm", "exe", "success")


def raw_fields(line: Column | str, names: tuple[str, ...]) -> Column:
    """Struct of field texts ('' if absent), each found by one search."""
    return F.struct(*[F.coalesce(field_value(line, n), F.lit("")).alias(n) for n in names])


def merged_commands(records: DataFrame, line: str = "msg", mode: str = "compat") -> DataFrame:
    """host, epoch_ms, serial and the command over all EXECVE records of an event.

    Pieces merge by event, argument and chunk first, copies of a record already
    before the shuffle; then one row a piece is left to be put in order, so an
    event is as large as its command, not as the number of its records.  Of
    different values for one piece the least counts.
    """
    known = records.filter(F.col("epoch_ms").isNotNull() & is_execve(line))
    parts = known.select(*EVENT_KEY, F.explode(X.argument_parts(line, mode)).alias("_p")).select(*EVENT_KEY, "_p.*")
    pieces = parts.groupBy(*EVENT_KEY, "width", "digits", "chunk").agg(F.min("val").alias("val"))
    joined = F.collect_list(F.struct("width", "digits", "chunk", "val"))
    return pieces.groupBy(*EVENT_KEY).agg(joined.alias("_p")).select(*EVENT_KEY, X.join_parts(F.col("_p")).alias("cmd"))


def event_aggregates(line: str = "msg", mode: str = "compat", cmd: Column | None = None) -> list[Column]:
    """Aggregates that turn the records of one event into one row.

    Every aggregate has a fixed size and merges before the shuffle, so an
    event with any number of records (or copies of them) never gathers in one
    buffer.  ``cmd`` gives the command, else it is that of one EXECVE record.
    """
    text, kind = F.col(line), F.col("record_type")
    first_path = (kind == "PATH") & text.rlike(r"\bitem=0\b")
    return [
        F.count("record_type").alias("n_records"),
        F.max(X.command(line, mode) if cmd is None else cmd).alias("cmd"),
        F.min(F.when(first_path, field_value(text, "name"))).alias("path"),
        F.max(F.when(kind == "SYSCALL", raw_fields(text, _CALL_IDS + _CALL_TEXTS))).alias("_call"),
        F.max(field_value(text, "key")).alias("key"),
        F.max(event_result(line)).alias("failed"),
    ]


def event_columns(df: DataFrame) -> DataFrame:
    """Typed columns of aggregated events."""
    kept = [c for c in df.columns if c not in ("_call", "key", "failed")]
    return df.select(
        *kept,
        *[id_value(F.col(f"_call.{n}")).alias(f"{n}_id") for n in _CALL_IDS],
        *[F.when(F.col(f"_call.{n}") != "", F.col(f"_call.{n}")).alias(n) for n in _CALL_TEXTS],
        "key",
        "failed",
    )


def assemble_events(records: DataFrame, line: str = "msg", mode: str = "compat") -> DataFrame:
    """One row per (host, epoch_ms, serial): ids of SYSCALL, command of all EXECVE records, first path.

    ``failed`` is 1 or 0 where a record tells a result, else NULL.  All paths
    are rows of ``event_paths``.
    Records without an audit header belong to no event and are left out here.
    """
    rows = records.filter(F.col("epoch_ms").isNotNull()).select(*EVENT_KEY, F.coalesce("record_type", F.lit("")).alias("record_type"), F.col(line))
    # Commands go through the same aggregation as rows of their own: no join, and hosts may be NULL.
    rows = rows.unionByName(merged_commands(records, line, mode).withColumnRenamed("cmd", "_cmd"), allowMissingColumns=True)
    return event_columns(rows.groupBy(*EVENT_KEY).agg(*event_aggregates(line, mode, F.col("_cmd"))))


def event_paths(records: DataFrame, line: str = "msg") -> DataFrame:
    """Every path of every event once: (host, epoch_ms, serial, item, path, nametype).

    Copies of a record merge before the shuffle.
    """
    text = F.col(line)
    rows = records.filter(F.col("epoch_ms").isNotNull() & (F.col("record_type") == "PATH"))
    return rows.select(
        *EVENT_KEY,
        field_value(text, "item").try_cast("int").alias("item"),
        field_value(text, "name").alias("path"),
        field_value(text, "nametype").alias("nametype"),
    ).distinct()


def search_events(
    records: DataFrame,
    start_ms: int | None = None,
    record_type: str | None = None,
    success: str | None = None,
    comm: str | None = None,
    key: str | None = None,
    line: str = "msg",
) -> DataFrame:
    """All records of the events that meet every criterion, each on any of their records."""
    given = {"start_ms": start_ms, "record_type": record_type, "success": success, "comm": comm, "key": key}
    tests = {n: search_condition(**{n: v}, line=line) for n, v in given.items() if v is not None}
    known = records.filter(F.col("epoch_ms").isNotNull())
    if not tests:
        return known
    # One flag a criterion, merged before the shuffle.
    flags = [F.max(F.coalesce(t, F.lit(False))).alias(f"_{n}") for n, t in tests.items()]
    keys = known.groupBy(*EVENT_KEY).agg(*flags)
    keys = keys.filter(reduce(lambda a, b: a & b, [F.col(f"_{n}") for n in tests])).select(*EVENT_KEY)
    return known.join(keys, EVENT_KEY, "left_semi")


def search_condition(
    start_ms: int | None = None,
    record_type: str | None = None,
    success: str | None = None,
    comm: str | None = None,
    key: str | None = None,
    line: str = "msg",
) -> Column:
    """All given criteria joined by AND; the start time is inclusive."""
    text = F.col(line)
    tests = []
    if start_ms is not None:
        tests.append(F.col("epoch_ms") >= start_ms)
    if record_type is not None:
        tests.append(F.col("record_type") == record_type)
    if success is not None:
        tests.append(field_value(text, "success") == success)
    if comm is not None:
        tests.append(field_value(text, "comm") == comm)
    if key is not None:
        tests.append(field_value(text, "key") == key)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def records_of(records: DataFrame, predicate: Column) -> DataFrame:
    """All records of the events that have a record satisfying ``predicate``.

    The keys are made unique before the semi join; the adaptive plan turns a
    selective search into a broadcast and splits hot keys otherwise.
    """
    keys = records.filter(predicate).select(*EVENT_KEY).distinct()
    return records.join(keys, EVENT_KEY, "left_semi")


def search(
    records: DataFrame,
    start_ms: int | None = None,
    key: str | None = None,
    record_type: str | None = None,
    success: str | None = None,
    comm: str | None = None,
    whole_events: bool = True,
    line: str = "msg",
) -> DataFrame:
    """Records that meet all criteria; a key stands for its whole event.

    The key sits on one record only, so a key search first finds the events
    and then applies the other criteria to all their records.
    """
    rest = search_condition(start_ms, record_type, success, comm, None, line)
    if key is None:
        return records.filter(rest)
    by_key = search_condition(start_ms, None, None, None, key, line)
    if not whole_events:
        return records.filter(by_key & rest)
    return records_of(records, by_key).filter(rest)


def contains_text(df: DataFrame, text: str, column: str = "msg") -> DataFrame:
    """Rows whose message contains ``text`` (literally)."""
    return df.filter(F.contains(F.col(column), F.lit(text)))


def any_match(df: DataFrame, text: str, column: str = "msg") -> DataFrame:
    """One row ``found``: does any message contain ``text``?"""
    hit = F.contains(F.col(column), F.lit(text))
    return df.agg(F.coalesce(F.max(hit), F.lit(False)).alias("found"))


def dedup_sources(df: DataFrame, prefer: str = "program", line: str = "msg") -> DataFrame:
    """Keep each audit record once when two sources deliver it.

    Copies agree on host, header, type and text; the one with the smallest
    ``prefer`` value stays.  Copies merge before the shuffle.  Lines without
    an audit header are no records and pass as they are.
    """
    columns = df.columns
    key = EVENT_KEY + ["record_type", line]
    rest = [prefer] + [c for c in columns if c not in key + [prefer]]
    kept = (
        df.filter(F.col("epoch_ms").isNotNull())
        .groupBy(*key)
        .agg(F.min(F.struct(*rest)).alias("_first"))
        .select(*key, "_first.*")
        .select(*columns)
    )
    return kept.unionByName(df.filter(F.col("epoch_ms").isNull()))


def delivery_gap(
    sent: DataFrame, received: DataFrame, line: str = "msg", host: str = "host"
) -> DataFrame:
    """Messages sent more often than received: host, digest, sent, received, missing.

    One aggregation over both sides instead of an anti join: equal messages
    are counted before the shuffle, so a message that makes up a large part of
    the log is one row per task.
    """
    digest = F.sha2(F.col(line), 256)
    side = lambda df, s, r: df.select(
        F.col(host).alias("host"), digest.alias("digest"),
        F.lit(s).cast("bigint").alias("sent"), F.lit(r).cast("bigint").alias("received"),
    )
    return (
        side(sent, 1, 0)
        .unionAll(side(received, 0, 1))
        .groupBy("host", "digest")
        .agg(F.sum("sent").alias("sent"), F.sum("received").alias("received"))
        .filter(F.col("sent") > F.col("received"))
        .withColumn("missing", F.col("sent") - F.col("received"))
    )


def first_match(df: DataFrame, event_key: list[str], order: str) -> DataFrame:
    """The row with the smallest ``order`` per event (first match wins)."""
    rest = [c for c in df.columns if c not in event_key and c != order]
    return (
        df.groupBy(*event_key)
        .agg(F.min(F.struct(order, *rest)).alias("_first"))
        .select(*event_key, "_first.*")
    )


def tag_by_key(df: DataFrame, line: str = "msg") -> DataFrame:
    """Add the key stamped on a record and the technique it names."""
    return df.withColumn("key", field_value(F.col(line), "key")).withColumn(
        "technique", technique_of_key("key")
    )
