"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line.  Every query result goes to the ``noop`` sink, so the
whole plan runs (a COUNT(*) would let Spark skip reading the measures).
Setup (fact lake unload, PROCESSED build) is timed separately.  For the
reference's pruning study, the three ways to answer the quarter statistic --
flat files, year/quarter/month folders, monthly aggregate table -- also report
the number and bytes of the files their scans select.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vellum.plans import queries as Q  # noqa: E402
from vellum.plans.warehouse import curated_for, lake_for, processed_for  # noqa: E402
from vellum.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))

HEADLINE = [
    "stats_nopart", "stats_part", "mv_stats", "stats_nopart_csv", "stats_part_csv",
    "final_integrated", "final_nopart", "final_filtered", "final_count",
    "curated_feedback", "flatten_product_json", "mv_rollup_quarter",
    "extract_documents", "new_files", "unload_partitioned", "pipeline_end_to_end", "stage_t1_t2",
]
ONE_SHOT = {"unload_partitioned", "pipeline_end_to_end", "extract_documents", "new_files", "stage_t1_t2"}


def _files(root: str, prefix: tuple[str, ...] = ()) -> tuple[int, int]:
    """Data files (and their bytes) a scan of ``root`` restricted to ``prefix`` folders opens."""
    path = os.path.join(root.replace("file:", ""), *prefix)
    n = size = 0
    for d, _, fs in os.walk(path):
        for f in fs:
            if f.endswith(".parquet") or f.endswith(".csv"):
                n += 1
                size += os.path.getsize(os.path.join(d, f))
    return n, size


def _warm_up(spark) -> None:
    """Start the JVM code paths and a Python worker outside any timing."""
    from pyspark.sql import functions as F
    from vellum.operators.extract import decoded_content
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()
    spark.range(8).select(decoded_content(F.lit(b"<html>x</html>")).alias("p")).collect()


def _run(spark, key: str, i: int) -> float:
    spark.sparkContext.setJobGroup(f"bench:{key}:{i}", key)
    t0 = time.perf_counter()
    Q.QUERIES[key](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    dt = time.perf_counter() - t0
    spark.sparkContext.setJobGroup("", "")
    return dt


def _scanned(log_dir: str) -> dict[str, dict[str, int]]:
    """Bytes and records read by the tasks of each query's last run, from the event log."""
    job_group, stage_job, per_run = {}, {}, {}
    files = sorted(os.path.join(d, n) for d, _, ns in os.walk(log_dir) for n in ns
                   if not n.startswith(".") and not n.startswith("appstatus"))
    for path in files:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    job_group[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    group = job_group.get(stage_job.get(ev.get("Stage ID")), "")
                    if not group.startswith("bench:"):
                        continue
                    m = (ev.get("Task Metrics") or {}).get("Input Metrics") or {}
                    acc = per_run.setdefault(group, {"bytes": 0, "records": 0})
                    acc["bytes"] += m.get("Bytes Read", 0)
                    acc["records"] += m.get("Records Read", 0)
    out: dict[str, dict[str, int]] = {}
    for group, acc in sorted(per_run.items()):
        _, key, _ = group.split(":")
        out[key] = acc      # later runs overwrite earlier ones: the last run's figures
    return out


def main() -> None:
    log_dir = tempfile.mkdtemp(prefix="bench-events-", dir="/tmp")
    spark = build_session(f"local[{CPUS}]", app="vellum-bench", shuffle_partitions=CPUS,
                          extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": f"file://{log_dir}",
                                 "spark.eventLog.compress": "false"})
    _warm_up(spark)
    t0 = time.perf_counter()
    lake = lake_for(spark, SF_DIR)
    lake.build()
    setup_lake = time.perf_counter() - t0
    t0 = time.perf_counter()
    processed_for(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    setup_processed = time.perf_counter() - t0
    t0 = time.perf_counter()
    curated_for(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    setup_curated = time.perf_counter() - t0

    times: dict[str, float] = {}
    for key in HEADLINE:
        runs = [_run(spark, key, i) for i in range(1 if key in ONE_SHOT else REPEATS)]
        times[key] = round(statistics.median(runs), 3)

    y, q = f"year={Q.STATS_YEAR}", f"quarter={Q.STATS_QUARTER}"
    scans = {
        "stats_nopart": _files(lake.nopart),
        "stats_part": _files(lake.part, (y, q)),
        "mv_stats": _files(lake.monthly, (y, q)),
        "stats_nopart_csv": _files(lake.csv_nopart),
        "stats_part_csv": _files(lake.csv_part, (y, q)),
    }
    spark.stop()
    read = _scanned(log_dir)
    out = {
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR).replace("sf", ""),
        "cpus": CPUS,
        "setup_sec": {"lake_unload": round(setup_lake, 3), "processed_build": round(setup_processed, 3),
                      "curated_build": round(setup_curated, 3)},
        "pruning": {k: {"files": n, "file_bytes": b, "bytes_read": read.get(k, {}).get("bytes"),
                        "records_read": read.get(k, {}).get("records"), "sec": times[k]}
                    for k, (n, b) in scans.items()},
        "bytes_read": {k: v["bytes"] for k, v in read.items()},
        "pruning_ratio": {
            "time_nopart_over_part": round(times["stats_nopart"] / max(times["stats_part"], 1e-9), 2),
            "bytes_nopart_over_part": round(scans["stats_nopart"][1] / max(scans["stats_part"][1], 1), 2),
            "time_nopart_over_mv": round(times["stats_nopart"] / max(times["mv_stats"], 1e-9), 2),
            "csv_time_nopart_over_part": round(times["stats_nopart_csv"] / max(times["stats_part_csv"], 1e-9), 2),
            "csv_bytes_nopart_over_part": round(scans["stats_nopart_csv"][1] / max(scans["stats_part_csv"][1], 1), 2),
            "bytes_read_nopart_over_part": _ratio(read, "stats_nopart", "stats_part"),
            "bytes_read_nopart_over_mv": _ratio(read, "stats_nopart", "mv_stats"),
            "csv_bytes_read_nopart_over_part": _ratio(read, "stats_nopart_csv", "stats_part_csv"),
        },
    }
    print(json.dumps(out))


def _ratio(read: dict, a: str, b: str):
    x, y = read.get(a, {}).get("bytes"), read.get(b, {}).get("bytes")
    return round(x / y, 2) if x and y else None


if __name__ == "__main__":
    main()
