"""Throughput on landed lines: python scale_bench.py [copies] [op ...]

Enlarges the derived lines (copies of the events table with shifted ids), lands
them once as Parquet text lines in a fresh folder, and reports lines per second
of each operator, next to a row-at-a-time Python loop over the same lines.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from bench import session
from logforge.facts import TECHNIQUES
from logforge.functions import audit as A
from logforge.operators import enrich, events, reduce, reports, routing, rule_match
from logforge.plans.fleet import accounts, derive_lines
from logforge.plans.flow import process_lines
from logforge.sources import rules
from logforge.sources.logs import parse_audit, parse_syslog
from tests.test_execve import expected


def land(spark: SparkSession, sf_dir: str, copies: int, hot: bool) -> str:
    """Lines of ``copies`` shifted event tables; ``hot`` gives one host a third of them."""
    events_df = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = events_df.count() // 8 * 8
    big = (
        events_df.filter(F.col("event_id") < n)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .repartition(64, "copy", "event_id")
        .withColumn("event_id", F.col("event_id") + F.col("copy") * n)
        .drop("copy")
    )
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/lines"
    lines = derive_lines(big)
    if hot:
        third = (F.col("event_id") / 8).cast("bigint") % 3 == 0
        lines = lines.withColumn("line", F.when(third, F.regexp_replace("line", r" host\d+ ", " host0 ")).otherwise(F.col("line")))
        lines = lines.withColumn("host", F.when(third, "host0").otherwise(F.col("host")))
    lines.write.parquet(path)
    return path


def python_rate(lines: list[str]) -> float:
    """Lines per second of the tests' row-at-a-time statement plus tagging."""
    start = time.perf_counter()
    for line in lines:
        cmd, _ = expected(line)
        if cmd is not None:
            [t for t, ps in TECHNIQUES.items() if any(p in cmd for p in ps)]
    return len(lines) / (time.perf_counter() - start)


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    spark = session()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    path = os.environ.get("LANDED") or land(spark, sf_dir, copies, bool(os.environ.get("HOT")))
    lines = spark.read.parquet(path)
    total = lines.count()
    passwd, groups = accounts(lines)
    passwd, groups = passwd.persist(), groups.persist()
    passwd.count(), groups.count()  # dimensions are ready before the clock starts
    records = parse_audit(lines)
    jobs = {
        "read": lambda: lines.select("line"),
        "parse_syslog": lambda: parse_syslog(lines.select("line"), "line"),
        "route": lambda: routing.route(parse_syslog(lines.select("line"), "line")).filter("route = 'FORWARD'"),
        "enrich": lambda: enrich.enrich_execve(lines.select("host", "msg"), passwd=passwd, groups=groups),
        "process_lines": lambda: process_lines(lines.select("line"), "line", passwd=passwd, groups=groups),
        "fields": lambda: enrich.extract_fields(lines.select("msg")),
        "shape_syscall": lambda: enrich.parse_shape(lines.select("msg"), "SYSCALL"),
        "dual_format": lambda: enrich.dual_format(enrich.forwarded_fields(lines.withColumn("ts", F.timestamp_micros("us")))),
        "kv_map": lambda: lines.select(A.kv_map("msg")),
        "technique_counts": lambda: reports.technique_counts(enrich.rebuild_commands(lines.select("msg", "user_id")), user="user_id"),
        "eps": lambda: reports.events_per_second(lines.withColumn("ts", F.timestamp_micros("us"))),
        "assemble": lambda: events.assemble_events(records),
        "records_of": lambda: events.search(records, key="T1169_Sudo"),
        "dedup": lambda: events.dedup_sources(records.unionByName(records.withColumn("program", F.lit("x")))),
        "delivery_gap": lambda: events.delivery_gap(lines, routing.forwarded(lines)),
        "repeats": lambda: reduce.reduce_repeats(lines, ["host", "program"], ["us", "event_id"]),
        "rate_cap": lambda: reduce.rate_cap(records.filter("epoch_ms IS NOT NULL").withColumn("s", F.expr("epoch_ms div 1000")), ["host", "s"], ["serial", "event_id"], 2),
        "rule_whatif": lambda: rule_match.ruleset_whatif(rule_match.normalize_events(records), rules.builtin_rules(spark)),
    }
    sample = [r[0] for r in lines.select("msg").limit(200_000).toLocalIterator()]
    out = {"lines": total, "path": path, "python_one_core": round(python_rate(sample))}
    for name in sys.argv[2:] or jobs:
        start = time.perf_counter()
        jobs[name]().write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        out[name] = {"sec": round(took, 2), "lines_per_sec": round(total / took)}
        print(name, out[name], file=sys.stderr, flush=True)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
