"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the input and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "execve_command", "execve_enriched_line", "execve_hex_decode", "technique_counts",
    "technique_daily", "route_debian", "processed_lines", "fields_compat", "shape_syscall",
    "selector_sinks", "dual_format", "eps_by_minute", "volume_reduction", "result_ratio",
    "event_assembly", "event_records_by_key", "dedup_sources", "delivery_gap",
    "repeat_reduction", "rate_cap", "top_commands", "rule_parse", "rule_disposition",
    "ruleset_whatif", "stream_route_enrich", "stream_repeat",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.extraJavaOptions", os.environ.get("BENCH_JAVA", ""))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from logforge.plans.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # start the executors
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
