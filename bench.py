"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and
cores. Every query is run once to warm up, then timed ``BENCH_RUNS`` times (default
3); the best time counts. Results go to Spark's noop sink, whole.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline.plans.registered import QUERIES  # noqa: E402
from tideline.session import build_session  # noqa: E402

HEADLINE = [
    "q3_mirror",
    "k4_apply_to_base",
    "k4_apply_stream",
    "t1_normalize",
    "t2_render_temporal",
    "t4_flatten",
    "t5_effective_key",
    "t6_row_kinds",
    "t8_fan_out",
    "p1_hash_partition",
    "p2_registry_partition",
    "p4_allocate",
    "k1_topic_frame",
    "k2_encode_rows",
    "k3_delete_event_keys",
    "s2_initial",
    "s7_offsets_for_times",
    "s8_replay_from",
    "q1_script_batch",
    "q3_mirror_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if i and (best is None or took < best):
                best = took
        times[name] = round(best, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
