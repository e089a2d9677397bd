"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEAT (default 3).  Each query is run once to warm up,
then BENCH_REPEAT times; the median wall time is reported.  Results are
consumed with the ``noop`` sink, so the whole plan runs but nothing is
collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderloom.plans import catalog  # noqa: E402
from orderloom.session import get_session  # noqa: E402

HEADLINE = [
    "release_item_pipeline",
    "convenience_charge_pipeline",
    "charge_latest_per_key",
    "gift_preference_flatten",
    "release_flatten",
    "release_line_counts",
    "effective_dated_join",
    "top3_per_group",
    "dq_tag_rows",
    "flatmap_words",
    "charge_upsert",
    "stream_upsert_charge",
]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    qs = catalog.queries()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in HEADLINE:
        fn = qs[name]
        try:
            run_once(spark, fn, sf_dir)  # warm-up
            times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeat)), 3)
        except Exception as e:  # noqa: BLE001 - report and keep measuring the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
