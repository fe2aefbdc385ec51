"""Registered queries: every operator over whole tables (or lines derived from them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logforge.functions import audit as A
from logforge.functions import execve as X
from logforge.functions import render as N
from logforge.functions import syslog as S
from logforge.functions.registry import map_lines, register_functions
from logforge.operators import enrich as E
from logforge.operators import events as V
from logforge.operators import heavy as H
from logforge.operators import reduce as D
from logforge.operators import reports as P
from logforge.operators import routing as R
from logforge.operators import rule_match as M
from logforge.operators.dictionary import match_dictionary
from logforge.plans.flow import process_lines
from logforge.operators.verdicts import record_verdicts as record_verdicts_of
from logforge.plans.fleet import accounts, derive_rule_lines, fleet_lines
from logforge.scale import fits, work_dir
from logforge.sources import lookups, rules
from logforge.sources.logs import (
    drop_blank,
    parse_audit,
    parse_received,
    parse_syslog,
    read_audit,
    read_messages,
    read_syslog,
    union_sources,
    with_audit_dispatch,
)
from logforge.sources.sinks import write_lines
from logforge.sources.years import with_years
from logforge.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY_US = 86_400_000_000
CAP = 2
SINCE_US = 1_705_276_800_000_000  # 2024-01-15
START_MS = 1_704_067_300_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    """The derived lines read back through the syslog parse."""
    return parse_syslog(fleet_lines(spark, sf).select("event_id", "us", "user_id", "line"), "line")


def _execve(spark: SparkSession, sf: str) -> DataFrame:
    return fleet_lines(spark, sf).filter(A.is_execve("msg"))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Audit records: lines with type, epoch_ms and serial."""
    return parse_audit(fleet_lines(spark, sf))


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.timestamp_micros("us"))


def _event_key(df: DataFrame, *more) -> DataFrame:
    return df.select(*V.EVENT_KEY, *more)


# --- command rebuild ---------------------------------------------------------


@query
def execve_command(spark, sf):
    return _execve(spark, sf).select("event_id", X.command("msg").alias("cmd"))


@query
def execve_command_strict(spark, sf):
    return _execve(spark, sf).select("event_id", X.command("msg", "strict").alias("cmd"))


@query
def execve_argument_rows(spark, sf):
    """Arguments one per row, in numeric index order."""
    return _execve(spark, sf).select(
        "event_id", F.posexplode(X.args("msg")).alias("position", "value")
    )


@query
def execve_clean_line(spark, sf):
    return _execve(spark, sf).select("event_id", X.clean_line("msg").alias("line_clean"))


@query
def execve_historic_line(spark, sf):
    return fleet_lines(spark, sf).select("event_id", X.historic_line("msg").alias("line_out"))


@query
def execve_hex_decode(spark, sf):
    """Whole texts hex-encoded as an argument and decoded again."""
    line = F.concat(F.lit('type=EXECVE argc=2 a0="echo" a1='), F.hex("text"))
    return _documents(spark, sf).select("doc_id", line.alias("line")).select(
        "doc_id", F.md5(X.command("line")).alias("cmd_md5")
    )


@query
def execve_enriched_line(spark, sf):
    lines = fleet_lines(spark, sf)
    passwd, groups = accounts(fleet_lines(spark, sf, text=False))
    out = E.enrich_execve(lines.filter(A.is_execve("msg")), passwd=passwd, groups=groups)
    return out.select("event_id", "line_out")


@query
def execve_passthrough(spark, sf):
    """All lines through the enricher: only EXECVE lines change."""
    out = E.enrich_execve(fleet_lines(spark, sf))
    return out.select("event_id", "line_out", (F.col("line_out") == F.col("msg")).alias("same"))


@query
def execve_manual_profile(spark, sf):
    out = E.enrich_execve(fleet_lines(spark, sf), profile="manual")
    return out.select("event_id", "line_out")


@query
def proctitle_drop(spark, sf):
    """Lines of even groups get a process title; their EXECVE lines go."""
    lines = fleet_lines(spark, sf).withColumn(
        "msg",
        F.when(F.expr("event_id div 8 % 2 = 0"), F.concat("msg", F.lit(" proctitle=1"))).otherwise(
            F.col("msg")
        ),
    )
    return R.drop_proctitle(lines).select("event_id")


@query
def execve_fallback_command(spark, sf):
    return fleet_lines(spark, sf).select("event_id", X.fallback_command("msg").alias("cmd"))


@query
def identity_names(spark, sf):
    lines = fleet_lines(spark, sf)
    passwd, groups = accounts(fleet_lines(spark, sf, text=False))
    out = E.resolve_ids(E.rebuild_commands(lines.filter(A.is_execve("msg"))), passwd, groups)
    return out.select(
        "event_id", "auid_id", "uid_id", "gid_id", "auid_name", "uid_name", "gid_name"
    )


@query
def technique_tags(spark, sf):
    return _execve(spark, sf).select(
        "event_id", X.technique_list(X.command("msg")).alias("techniques")
    )


@query
def technique_counts(spark, sf):
    out = E.rebuild_commands(_execve(spark, sf))
    return P.technique_counts(out, user="user_id")


@query
def technique_counts_strict(spark, sf):
    out = E.rebuild_commands(_execve(spark, sf), mode="strict")
    return P.technique_counts(out)


@query
def technique_daily(spark, sf):
    out = E.rebuild_commands(_execve(spark, sf)).withColumn("day", F.expr(f"us div {DAY_US}"))
    return P.technique_counts(out, keys=("day", "host"))


@query
def technique_users(spark, sf):
    """Distinct users per technique over all days, added up from stored daily sketches, against the exact number.

    ``close`` tells that the estimate is within five percent (three standard errors).
    """
    tags = F.split(X.technique_list("cmd"), ",")
    rows = E.rebuild_commands(_execve(spark, sf)).withColumn("day", F.expr(f"us div {DAY_US}"))
    rows = rows.select("day", "user_id", F.explode(tags).alias("technique"))
    path = work_dir(spark, "sketches")
    H.distinct_sketches(rows, ["technique", "day"], "user_id").write.parquet(path)
    about = H.add_up(spark.read.parquet(path), ["technique"])
    exact = rows.groupBy("technique").agg(F.countDistinct("user_id").alias("n_users"))
    close = F.abs(F.col("n") - F.col("n_users")) <= F.col("n_users") * 0.05
    return exact.join(about, "technique").select("technique", "n_users", close.alias("close"))


@query
def technique_dictionary(spark, sf):
    """A dictionary of thousands of patterns, taken from the events, over all commands."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    user = events.select(F.concat(F.lit("user"), "user_id").alias("pattern"), F.concat(F.lit("T"), F.col("user_id") % 50).alias("technique"))
    file = events.filter("event_type = 'purchase'").select(F.concat(F.lit("/f"), "event_id").alias("pattern"), F.concat(F.lit("F"), F.col("event_id") % 20).alias("technique"))
    short = events.select(F.concat(F.lit("f"), F.col("user_id") % 10).alias("pattern"), F.lit("S").alias("technique"))
    commands = _execve(spark, sf).select("event_id", X.command("msg").alias("cmd"))
    found = match_dictionary(commands, user.union(file).union(short), ["event_id"])
    return found.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("technique")), ",").alias("techniques"))


@query
def document_techniques(spark, sf):
    """Technique dictionary over whole document texts."""
    docs = _documents(spark, sf).select("doc_id", X.techniques("text").alias("techniques"))
    return P.technique_counts(docs)


@query
def top_commands(spark, sf):
    return P.top_k(_execve(spark, sf).select(X.command("msg").alias("cmd")), "cmd", 10)


@query
def top_messages(spark, sf):
    """The most frequent messages by summaries of 256 counters a task and an exact pass."""
    return H.heavy_hitters(fleet_lines(spark, sf), "msg", 8, 256).select(F.col("key").alias("msg"), F.col("n").alias("n_lines"))


@query
def top_users(spark, sf):
    """Login ids by number of audit records."""
    lines = fleet_lines(spark, sf).select(A.field_value("msg", "auid").alias("auid"))
    return P.top_k(lines, "auid", 3)


@query
def sql_functions(spark, sf):
    """The registered SQL functions over all lines."""
    register_functions(spark)
    return fleet_lines(spark, sf).select(
        "event_id",
        F.expr("audit_record_type(msg)").alias("record_type"),
        F.expr("audit_result(msg)").alias("result"),
        F.expr("execve_command(msg)").alias("cmd"),
    )


def _after_header(line: str) -> str | None:
    """A line function: text after the audit header; PATH records are dropped."""
    return None if line.startswith("type=PATH") else line.split("): ", 1)[-1]


@query
def line_hook(spark, sf):
    """A Python line function through Arrow batches."""
    lines = fleet_lines(spark, sf).select("event_id", "msg")
    return map_lines(lines, _after_header, "msg").select("event_id", F.md5("msg").alias("out_md5"))


# --- parsing and fields ------------------------------------------------------


@query
def syslog_parse(spark, sf):
    return _parsed(spark, sf).select(
        "event_id", F.unix_millis("ts").alias("ts_ms"), "host", "facility", "severity", "program",
        F.md5("msg").alias("msg_md5"),
    )


@query
def pri_decode(spark, sf):
    return _parsed(spark, sf).select(
        "event_id", "pri", "facility", "severity", "facility_text",
        S.severity_text("severity").alias("severity_text"),
    )


@query
def received_parse(spark, sf):
    """Receiver rendering read back: time, host, tag, message."""
    out = E.render_received(_timed(fleet_lines(spark, sf))).select("event_id", "line_out")
    return parse_received(out, "line_out").select(
        "event_id", F.unix_millis("ts").alias("ts_ms"), "host", "tag", F.md5("msg").alias("msg_md5")
    )


@query
def blank_drop(spark, sf):
    """Document lines, stripped, without the empty ones."""
    lines = _documents(spark, sf).select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    return drop_blank(lines).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


@query
def record_type(spark, sf):
    return fleet_lines(spark, sf).select("event_id", A.record_type("msg").alias("record_type"))


@query
def record_type_fallback(spark, sf):
    return fleet_lines(spark, sf).select(
        "event_id", A.record_type("msg", "fallback").alias("record_type")
    )


@query
def audit_result(spark, sf):
    return fleet_lines(spark, sf).select("event_id", A.audit_result("msg").alias("result"))


_FIELDS = ("audit_type", "auid", "uid", "euid", "pid", "exe", "success", "key")


@query
def fields_compat(spark, sf):
    out = E.extract_fields(fleet_lines(spark, sf).select("event_id", "msg"))
    return out.select("event_id", *_FIELDS)


@query
def fields_strict(spark, sf):
    out = E.extract_fields(fleet_lines(spark, sf).select("event_id", "msg"), "strict")
    return out.select("event_id", *_FIELDS)


@query
def audit_header(spark, sf):
    return _records(spark, sf).select("event_id", "record_type", "epoch_ms", "serial")


def _shape(spark, sf, shape):
    out = E.parse_shape(fleet_lines(spark, sf).select("event_id", "msg"), shape)
    return out.filter(F.col("shape").isNotNull()).select("event_id", "shape.*")


@query
def shape_user_auth(spark, sf):
    return _shape(spark, sf, "USER_AUTH")


@query
def shape_user_cmd(spark, sf):
    out = _shape(spark, sf, "USER_CMD")
    return out.withColumn("command", X.decode_hex(F.col("cmd")))


@query
def shape_syscall(spark, sf):
    return _shape(spark, sf, "SYSCALL")


@query
def shape_execve(spark, sf):
    """The shape wants exactly four quoted arguments: a fourth one is appended."""
    lines = fleet_lines(spark, sf).select(
        "event_id", F.concat("msg", F.lit(' a3="'), "event_type", F.lit('"')).alias("msg")
    )
    out = E.parse_shape(lines, "EXECVE")
    return out.filter(F.col("shape").isNotNull()).select("event_id", "shape.*")


@query
def kv_names(spark, sf):
    """Every field name of every record, with its count and extreme values."""
    lines = fleet_lines(spark, sf).select(F.explode(A.kv_map("msg")).alias("name", "value"))
    return lines.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


@query
def id_predicates(spark, sf):
    ids = fleet_lines(spark, sf).select(
        A.field_value("msg", "auid").alias("auid"), A.field_value("msg", "uid").alias("uid")
    )
    return ids.select(
        A.auid_is_user("auid").alias("person"), A.is_unset("auid").alias("unset"),
        F.coalesce(F.col("uid") == "0", F.lit(False)).alias("root"),
    ).groupBy("person", "unset", "root").agg(F.count(F.lit(1)).alias("n_lines"))


# --- routing and filters -----------------------------------------------------


def _route(profile):
    def run(spark, sf):
        return R.route(_parsed(spark, sf), profile).select("event_id", "route")

    return run


for _profile in ("universal", "debian", "rhel", "manual"):
    QUERIES[f"route_{_profile}"] = _route(_profile)


@query
def split_outputs(spark, sf):
    """Forwarded lines and the enriched copy, counted per output and program."""
    raw, tee = R.split_outputs(_parsed(spark, sf))
    tag = lambda df, name: df.select(F.lit(name).alias("output"), "program")
    return tag(raw, "raw").unionAll(tag(tee, "enrich")).groupBy("output", "program").agg(
        F.count(F.lit(1)).alias("n_lines")
    )


@query
def processed_lines(spark, sf):
    """The whole line job: parse, route, enrich; one row per forwarded line."""
    lines = fleet_lines(spark, sf)
    passwd, groups = accounts(fleet_lines(spark, sf, text=False))
    out = process_lines(lines.select("event_id", "line"), "line", passwd=passwd, groups=groups)
    return out.select("event_id", "route", "cmd", "mitre_techniques", F.md5("line_out").alias("out_md5"))


@query
def ignore_lookup(spark, sf):
    lines = fleet_lines(spark, sf, text=False).select("event_id", "program")
    return R.apply_lookup(lines, lookups.ignored_programs(spark))


@query
def ignore_drop(spark, sf):
    lines = fleet_lines(spark, sf, text=False).select("event_id", "program")
    return R.drop_ignored(lines, lookups.ignored_programs(spark))


@query
def selector_sinks(spark, sf):
    lines = _parsed(spark, sf).select("event_id", "facility", "severity")
    return R.route_selectors(lines, local_copy="audit-copy").select("event_id", "sink")


@query
def exclude_types(spark, sf):
    lines = fleet_lines(spark, sf).select("event_id", "msg")
    return R.exclude_types(lines, ("PATH", "USER_AUTH")).select("event_id")


@query
def security_keywords(spark, sf):
    return R.keep_keywords(fleet_lines(spark, sf)).select("event_id", "msg")


@query
def noise_text(spark, sf):
    return R.drop_text(fleet_lines(spark, sf), ("click message", "view message")).select("event_id")


@query
def document_keywords(spark, sf):
    """Keyword and operational-text tests over whole document texts."""
    docs = _documents(spark, sf)
    kept = R.keep_keywords(docs, ("error", "attack", "the"), "text").select("doc_id")
    rest = R.drop_text(docs, ("the",), "text").select("doc_id")
    return kept.withColumn("test", F.lit("keyword")).unionAll(rest.withColumn("test", F.lit("no text")))


@query
def message_search(spark, sf):
    return V.contains_text(fleet_lines(spark, sf), "access denied").select("event_id", "host")


@query
def message_exists(spark, sf):
    return V.any_match(fleet_lines(spark, sf), "access denied")


@query
def document_search(spark, sf):
    return V.contains_text(_documents(spark, sf), "th", "text").select("doc_id")


# --- rendering ---------------------------------------------------------------


@query
def render_rfc3339(spark, sf):
    return E.render_rfc3339(_timed(fleet_lines(spark, sf))).select("event_id", "line_out")


@query
def render_received(spark, sf):
    return E.render_received(_timed(fleet_lines(spark, sf))).select("event_id", "line_out")


@query
def render_traditional(spark, sf):
    return E.render_traditional(_timed(fleet_lines(spark, sf))).select("event_id", "line_out")


@query
def render_leef(spark, sf):
    out = E.forwarded_fields(_timed(fleet_lines(spark, sf)))
    return E.render_leef(out).select("event_id", "line_out")


@query
def render_json(spark, sf):
    out = E.render_json(
        E.forwarded_fields(fleet_lines(spark, sf)), ["host", "audit_type", "exe", "cmd"]
    )
    return out.select("event_id", F.from_json("line_out", "host STRING, audit_type STRING, exe STRING, cmd STRING").alias("j")).select("event_id", "j.*")


@query
def render_octets(spark, sf):
    return E.frame_octets(fleet_lines(spark, sf), "line").select("event_id", F.col("line").alias("line_out"))


@query
def dual_format(spark, sf):
    out = E.forwarded_fields(_timed(fleet_lines(spark, sf)))
    return E.dual_format(out).select("event_id", "format", F.md5("line_out").alias("out_md5"))


def _landed(spark, df, column, name):
    """Folder with the lines as text files."""
    path = work_dir(spark, name)
    write_lines(df, path, column)
    return path


@query
def direct_tail(spark, sf):
    """Audit log files tailed past syslog, fields extracted, commands put together, sent in two formats."""
    lines = fleet_lines(spark, sf).filter("program = 'audit'").withColumn("msg", F.concat(F.lit("node="), "host", F.lit(" "), "msg"))
    tailed = read_audit(spark, _landed(spark, lines, "msg", "tail"))
    out = E.dual_format(E.forwarded_fields(tailed))
    return out.select("host", F.unix_millis("ts").alias("ts_ms"), "format", F.md5("line_out").alias("out_md5"))


@query
def syslog_files(spark, sf):
    """Landed syslog files and message files as two sources, counted per program."""
    lines = fleet_lines(spark, sf)
    syslog = read_syslog(spark, _landed(spark, lines.filter("program <> 'kernel'"), "line", "syslog")).withColumn("source", F.lit("syslog"))
    messages = read_messages(spark, _landed(spark, lines.filter("program = 'kernel'"), "line", "messages"))
    both = union_sources(syslog, messages)
    return both.groupBy("source", "program", "facility", "severity").agg(F.count(F.lit(1)).alias("n_lines"), F.min(F.unix_millis("ts")).alias("first_ms"))


@query
def audit_dispatch(spark, sf):
    """Audit records that enter syslog under facility local3."""
    records = _records(spark, sf).filter("epoch_ms IS NOT NULL").drop("facility")
    return with_audit_dispatch(records).select("event_id", "facility", "facility_text")


@query
def lookup_file(spark, sf):
    """A lookup file of the programs that the first events' lines come from, applied to all lines."""
    lines = fleet_lines(spark, sf, text=False).select("event_id", "program")
    quiet = lines.filter("program IN ('cron', 'nginx', 'postfix')").select(F.struct(F.col("program").alias("index"), F.lit("IGNORE").alias("value")).alias("e"))
    # One small object: at most three programs.
    table = quiet.agg(F.array_sort(F.collect_set("e")).alias("table")).select(F.lit(1).alias("version"), F.lit("PASS").alias("nomatch"), F.lit("string").alias("type"), "table")
    path = work_dir(spark, "lookup")
    table.coalesce(1).write.json(path)
    return R.apply_lookup(lines, lookups.read_lookup(spark, path))


@query
def yearless_stamps(spark, sf):
    """Stamps without a year, a day apart, in files that run over several new years."""
    lines = fleet_lines(spark, sf, text=False).select("event_id", "host", F.col("event_id").alias("at"))
    when = F.date_add(F.lit("2021-03-01").cast("date"), (F.col("event_id") % 900).cast("int"))
    made = lines.withColumn("file", F.expr("event_id div 900")).withColumn("stamp", F.concat(F.date_format(when, "MMM dd"), F.lit(" 10:00:00")))
    last = made.groupBy("file").agg(F.max("at").alias("_last")).withColumn("written", F.timestamp_seconds((F.unix_date(F.lit("2021-03-01").cast("date")) + F.col("_last") % 900) * 86400 + 40 * 3600))
    dated = with_years(made.join(F.broadcast(last.drop("_last")) if fits(last) else last.drop("_last"), "file"), ["file"], "at", "stamp", "written")
    return dated.select("event_id", F.substring(N.utc_text("ts"), 1, 19).alias("ts"))


# --- reports -----------------------------------------------------------------


@query
def received_report(spark, sf):
    return P.received_count(R.forwarded(_parsed(spark, sf), "universal"))


@query
def unwanted_programs(spark, sf):
    return P.unwanted_report(fleet_lines(spark, sf)).select("program", "n_lines", "seen")


@query
def unwanted_count(spark, sf):
    return P.unwanted_count(R.forwarded(fleet_lines(spark, sf)))


@query
def volume_since(spark, sf):
    lines = _timed(fleet_lines(spark, sf, text=False))
    return P.volume_since(lines, F.timestamp_micros(F.lit(SINCE_US)))


@query
def eps_by_minute(spark, sf):
    out = P.events_per_second(_timed(fleet_lines(spark, sf, text=False)))
    return out.select(F.unix_micros("window.start").alias("start_us"), "host", "n_lines")


@query
def sliding_volume(spark, sf):
    """Lines per host in windows of ten minutes that begin every five."""
    out = P.sliding_counts(_timed(fleet_lines(spark, sf, text=False)))
    return out.select(F.unix_micros("window.start").alias("start_us"), "host", "n_lines")


@query
def host_bursts(spark, sf):
    """Bursts of a host's lines, apart by more than half an hour."""
    return P.bursts(fleet_lines(spark, sf, text=False), 1800)


@query
def volume_reduction(spark, sf):
    lines = R.route(fleet_lines(spark, sf, text=False))
    return P.volume_reduction(lines).select("route", "program", F.col("level").cast("int").alias("level"), "n_lines")


@query
def result_ratio(spark, sf):
    return P.result_ratio(fleet_lines(spark, sf), ("record_type", "program"))


# --- events ------------------------------------------------------------------


@query
def event_assembly(spark, sf):
    return V.assemble_events(_records(spark, sf))


@query
def split_commands(spark, sf):
    """Commands whose arguments come in several records and chunks, each record delivered twice."""
    lines = fleet_lines(spark, sf).filter(A.is_execve("msg")).select("event_id", "host", "msg")
    head = F.regexp_extract("msg", r"^(type=EXECVE msg=\S+ )", 1)
    long = F.repeat(F.concat(F.lit("é"), F.col("event_id").cast("string")), 3)
    half = (F.length(F.hex(long.cast("binary"))) / 4).cast("int") * 2
    piece = lambda k, text: F.concat(head, F.lit(f"a2[{k}]="), text)
    parts = F.array(
        F.concat(head, F.lit('argc=4 a0="run" a1="-x"')),
        piece(0, F.substr(F.hex(long.cast("binary")), F.lit(1), half)),
        piece(1, F.substr(F.hex(long.cast("binary")), half + 1)),
        F.concat(head, F.lit(' a2_len=99 a3="'), F.col("event_id").cast("string"), F.lit('" a10="end"')),
    )
    rows = lines.select("host", "event_id", F.explode(F.concat(parts, F.reverse(parts))).alias("msg"))
    return V.assemble_events(parse_audit(rows)).select(*V.EVENT_KEY, "n_records", "cmd")


@query
def event_enrichment(spark, sf):
    """Events with names from SYSCALL and techniques from EXECVE."""
    passwd, groups = accounts(fleet_lines(spark, sf, text=False))
    out = E.enrich_events(_records(spark, sf), passwd, groups)
    return _event_key(out, "cmd", "mitre_techniques", "auid_name", "uid_name", "gid_name")


@query
def event_search(spark, sf):
    out = V.search(_records(spark, sf), start_ms=START_MS, record_type="SYSCALL", success="yes", comm="sudo")
    return out.select("event_id", "epoch_ms", "serial")


@query
def event_search_across(spark, sf):
    """Events with a path record and, on another record, the command."""
    out = V.search_events(_records(spark, sf), record_type="PATH", comm="sudo")
    return out.select("event_id", "epoch_ms", "serial", "record_type")


@query
def event_paths(spark, sf):
    return V.event_paths(_records(spark, sf))


@query
def undated_lines(spark, sf):
    """Every tenth line has lost its time."""
    lines = fleet_lines(spark, sf, text=False).select("event_id", "host")
    lines = lines.withColumn("ts", F.when(F.col("event_id") % 10 != 3, F.lit(0).cast("timestamp")))
    return P.undated(lines)


@query
def odd_fields(spark, sf):
    """Quoted blanks, hex texts (also bytes that are no UTF-8), ``(null)`` and enriched tails, made from the events."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    key = F.when(F.col("event_id") % 3 == 0, F.lit("(null)")).otherwise(F.concat(F.lit('"k'), "user_id", F.lit('"')))
    line = F.concat(
        F.lit('type=SYSCALL exe='), F.hex(F.concat(F.lit("/opt/a b/"), "event_id").cast("binary")),
        F.lit(' name="/srv/my files/'), "event_type", F.lit('" comm="Web '), "user_id", F.lit('" key='), key,
        F.lit(" cwd=2F746D702FFFC3"), F.hex(F.col("event_id").cast("string").cast("binary")), F.lit('\x1dARCH=x86_64 SYSCALL=execve UID="root"'),
    )
    lines = events.select("event_id", line.alias("msg"))
    return lines.select("event_id", *[A.field_value("msg", n).alias(n) for n in ("name", "comm", "key", "exe", "cwd")])


@query
def odd_rendering(spark, sf):
    """Lines that lack time, host or program are rendered all the same."""
    lines = fleet_lines(spark, sf).withColumn("ts", F.lit(None).cast("timestamp"))
    lines = lines.withColumn("host", F.when(F.col("event_id") % 3 != 0, F.col("host"))).withColumn("program", F.when(F.col("event_id") % 5 != 0, F.col("program")))
    return lines.select("event_id", F.regexp_extract(N.rfc3339(), r"(?s)^<\d+>- (.*)$", 1).alias("tail"))


@query
def event_records_by_key(spark, sf):
    out = V.search(_records(spark, sf), start_ms=START_MS, key="T1169_Sudo")
    return out.select("event_id", *V.EVENT_KEY, "record_type")


@query
def key_tagging(spark, sf):
    out = V.tag_by_key(fleet_lines(spark, sf).select("event_id", "msg"))
    return out.select("event_id", "key", "technique")


def _two_sources(spark, sf):
    audit = _records(spark, sf)
    direct = audit.filter(F.col("program") == "audit").withColumn("program", F.lit("audit-direct"))
    return union_sources(direct, audit)


@query
def union_source_counts(spark, sf):
    return _two_sources(spark, sf).groupBy("program").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def dedup_sources(spark, sf):
    return V.dedup_sources(_two_sources(spark, sf)).select("event_id", "program", F.md5("msg").alias("msg_md5"))


@query
def delivery_gap(spark, sf):
    """What the debian profile does not deliver, against everything sent."""
    lines = fleet_lines(spark, sf)
    return V.delivery_gap(lines, R.forwarded(lines))


@query
def repeat_reduction(spark, sf):
    return D.reduce_repeats(fleet_lines(spark, sf), ["host", "program"], ["us", "event_id"])


@query
def document_line_repeats(spark, sf):
    """Repeated lines inside whole documents, collapsed."""
    lines = _documents(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "text"))
    out = D.reduce_repeats(lines, ["doc_id"], ["at"], "text")
    return out.select("doc_id", F.md5("text").alias("text_md5"), "repeats", "first_at", "last_at")


def _seconds(spark, sf):
    return _records(spark, sf).filter(F.col("epoch_ms").isNotNull()).withColumn("second", F.expr("epoch_ms div 1000"))


@query
def rate_cap(spark, sf):
    out = D.rate_cap(_seconds(spark, sf), ["host", "second"], ["serial", "event_id"], CAP)
    return out.select("event_id", "host", "second", "serial")


@query
def rate_cap_report(spark, sf):
    return D.rate_cap_report(_seconds(spark, sf), ["host", "second"], CAP)


@query
def tail_lines(spark, sf):
    return D.tail(fleet_lines(spark, sf), 5, ["us", "event_id"]).select("event_id", "line")


# --- rules as data -----------------------------------------------------------


def _rule_rows(spark, sf):
    return rules.parse_rules(derive_rule_lines(spark.read.parquet(f"{sf}/events.parquet")))


@query
def rule_parse(spark, sf):
    return _rule_rows(spark, sf).select(
        "ruleset", "idx", "kind", "list", "action", "path", "is_dir", "perm",
        F.array_join("syscalls", ",").alias("syscalls"),
        F.array_join(F.transform("fields", lambda f: F.concat(f["name"], f["op"], f["value"])), " ").alias("fields"),
        "key", "technique",
    )


@query
def rules_inventory(spark, sf):
    return P.rules_inventory(_rule_rows(spark, sf))


@query
def rule_key_technique(spark, sf):
    rows = _rule_rows(spark, sf).filter(F.col("key").isNotNull())
    return rows.groupBy("key", "technique").agg(F.count(F.lit(1)).alias("n_rules"))


@query
def ruleset_diff(spark, sf):
    """Rules listed in the first half of the month against the second half."""
    lines = derive_rule_lines(spark.read.parquet(f"{sf}/events.parquet"))
    early = F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    out = rules.ruleset_diff(rules.parse_rules(lines.filter(early)), rules.parse_rules(lines.filter(~early)))
    return out.select("signature", "n_a", "n_b", "side")


@query
def dead_rules(spark, sf):
    """Rules of the hosts' listings that an earlier rule covers, so that they never decide."""
    return M.covered_rules(_rule_rows(spark, sf))


@query
def rules_strict(spark, sf):
    out = rules.strict_rules(_rule_rows(spark, sf).filter(F.col("kind") != "control"))
    return out.groupBy("ruleset", "kind").agg(
        F.count(F.lit(1)).alias("n_rules"), F.sum("idx").alias("sum_idx")
    )


def _rule_events(spark, sf):
    return M.normalize_events(_records(spark, sf))


def _matches(spark, sf, *names):
    return M.match_rules(_rule_events(spark, sf), rules.builtin_rules(spark, *names))


@query
def normalized_events(spark, sf):
    return _event_key(
        _rule_events(spark, sf), "arch", "syscall", "success", "exit", "auid", "uid", "gid",
        "euid", "a0", "path", "access",
    )


@query
def watch_match(spark, sf):
    """File watches of all rule sets against the paths events touch."""
    out = _matches(spark, sf).filter(F.col("kind") == "watch")
    return _event_key(out, "path", "ruleset", "idx", "key")


@query
def syscall_match(spark, sf):
    out = _matches(spark, sf).filter(F.col("kind") == "syscall")
    return _event_key(out, "path", "ruleset", "idx", "key")


@query
def rule_disposition(spark, sf):
    out = M.disposition(_matches(spark, sf))
    return _event_key(out, "ruleset", "idx", "key", "technique")


@query
def ruleset_whatif(spark, sf):
    return M.ruleset_whatif(_rule_events(spark, sf), rules.builtin_rules(spark))


@query
def never_rules(spark, sf):
    """Events left after suppression: successful calls touching /etc go."""
    lines = [("local", 0, "-a never,exit -F arch=b64 -S execve -F dir=/etc -F success=1"),
             ("local", 1, "-a exit,always -F arch=b64 -S all -k everything")]
    own = rules.parse_rules(spark.createDataFrame(lines, "ruleset STRING, idx INT, value STRING"))
    return _event_key(M.apply_never(_rule_events(spark, sf), own), "path")


@query
def exclude_rules(spark, sf):
    lines = [("local", 0, "-a always,exclude -F msgtype=PATH"), ("local", 1, "-a exclude,always -F msgtype=USER_CMD")]
    own = rules.parse_rules(spark.createDataFrame(lines, "ruleset STRING, idx INT, value STRING"))
    return M.apply_excludes(_records(spark, sf), own).select("event_id", "record_type")


@query
def record_verdicts(spark, sf):
    """Every record judged by the exclude, user and exit lists of one set."""
    lines = [
        "-a always,exclude -F msgtype=PATH", "-a never,exclude -F msgtype=EXECVE -F auid=1002", "-a never,user -F msgtype=USER_CMD -F auid=1003",
        "-a never,user -F auid=1004 -F msgtype!=USER_CMD", "-a never,exit -F arch=b64 -S execve -F dir=/etc -F success=1", "-a exit,always -F arch=b64 -S execve -F success=1 -k done",
    ]
    own = rules.parse_rules(spark.createDataFrame([("local", i, v) for i, v in enumerate(lines)], "ruleset STRING, idx INT, value STRING"))
    return record_verdicts_of(_records(spark, sf), own).select("event_id", "list", "idx", "kept")


# --- streams -----------------------------------------------------------------


@query
def stream_route_enrich(spark, sf):
    """The line job as a stream; same rows as the batch run."""
    return jobs.stream_route_enrich(spark, sf).select(
        "event_id", "route", "cmd", "mitre_techniques", F.md5("line_out").alias("out_md5")
    )


@query
def stream_eps(spark, sf):
    """Closed five-minute windows of a watermarked stream."""
    return jobs.stream_eps(spark, sf)


@query
def stream_assembly(spark, sf):
    return jobs.stream_assembly(spark, sf)


@query
def stream_late(spark, sf):
    """Late lines have an output of their own."""
    return jobs.stream_late(spark, sf)


@query
def stream_dedup(spark, sf):
    return jobs.stream_dedup(spark, sf)


@query
def stream_bursts(spark, sf):
    """The bursts of hosts as a stream with timers; same rows as the batch report."""
    return jobs.stream_bursts(spark, sf)


@query
def stream_repeat(spark, sf):
    """Runs collapsed across micro-batches."""
    return jobs.stream_repeat(spark, sf)


@query
def stream_gap(spark, sf):
    """Sent against received as an outer join of two streams, closed by its state."""
    return jobs.stream_gap(spark, sf)
