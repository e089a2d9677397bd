"""Skew evidence: run operators on data where one key holds a third of all
rows and report, from Spark's event log, the largest per-task shuffle read.

Usage: python tools/skew_check.py [rows]   (prints a markdown table)

The event log goes to a fresh scratch folder; tasks that read shuffle data
are grouped per job, and the maximum records one task read is compared with
the hot key's row count.  A partition strategy that funnels the hot key into
one task shows a maximum close to that count.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from orderloom.operators import dedupe, joins, ranking  # noqa: E402
from orderloom.session import SESSION_DEFAULTS  # noqa: E402
from orderloom.sources.events import nest_children  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    log_dir = tempfile.mkdtemp(prefix="orderloom-eventlog-")
    b = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
         .config("spark.eventLog.rolling.enabled", "false")
         .config("spark.eventLog.compress", "false")
         .config("spark.sql.shuffle.partitions", "16"))
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    # keep every reduce partition its own task, so one task's read is the
    # data that partitioning sent to it (AQE would merge small partitions)
    b = b.config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # skew-join thresholds scaled to this data size (cluster defaults: 256 MB)
    b = (b.config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1m")
         .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    hot = n // 3
    # one key (0) holds a third of all rows; the rest are spread over many keys
    df = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 1000).alias("ts"), F.col("id").alias("v"),
        (F.col("id") % 7).cast("int").alias("line"))
    jobs = {
        "latest_per_key": lambda: dedupe.latest_per_key(df, ["k"], "ts", ["v"]),
        "remove_duplicates": lambda: dedupe.remove_duplicates(df, ["k"], ["v"]),
        "duplicate_keys": lambda: dedupe.duplicate_keys(df, ["k"]),
        "top_n_per_group": lambda: ranking.top_n_per_group(df, ["k"], "v", 3, "row_number"),
        # an order's lines are nested by ship node (here 1000 of them)
        "nest_children": lambda: nest_children(df.select("k", F.col("ts").alias("node"), "line", "v"),
                                               ["k", "node"], "items"),
        # a third of all rows share the top value
        "nth_highest (rank, ties)": lambda: ranking.nth_highest(
            df.select("v", F.when(F.col("k") == 0, F.lit(n)).otherwise(F.col("ts")).alias("s")), "s", 1, "rank"),
        "top_n_per_group (dense_rank, ties)": lambda: ranking.top_n_per_group(
            df.select("line", F.when(F.col("k") == 0, F.lit(n)).otherwise(F.col("ts")).alias("s")), ["line"], "s", 3),
        "join_dimension (shuffle path)": lambda: joins.join_dimension(
            df, spark.range(0, n, 1, 16).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("w")),
            F.col("k") == F.col("dk"), "inner", max_bytes=1),
        # contrast: a whole-group window with no limit sends the hot key to one task
        "naive_window_latest (contrast)": lambda: df.withColumn(
            "rn", F.row_number().over(Window.partitionBy("k").orderBy(F.col("ts").desc()))),
    }
    names = []
    for name, build in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
        names.append(name)
    spark.stop()

    reads = defaultdict(list)   # job group -> records read by each shuffle-reading task
    stage_group = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif ev == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    g = stage_group.get(e.get("Stage ID"))
                    if r and g:
                        reads[g].append(r)
    print(f"rows = {n:,}; hot key rows = {hot:,}\n")
    print("| operator | shuffle-reading tasks | max records read by one task | share of hot key |")
    print("|---|---|---|---|")
    for name in names:
        r = reads.get(name, [])
        mx = max(r) if r else 0
        print(f"| {name} | {len(r)} | {mx:,} | {mx / hot:.4f} |")


if __name__ == "__main__":
    main()
