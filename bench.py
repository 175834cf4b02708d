"""Benchmark the headline queries; prints ONE JSON line on stdout.

Env: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_EVENT_LOG_DIR`` (optional: write Spark's event log
there for stage and task times).  Every query runs to completion through the ``noop`` sink, so
the full result is computed but nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "strip_markup", "drop_blank", "nav_links", "article_titles", "char_tokens",
    "sentence_split", "first_seen", "reconcile_visited", "frontier_union",
    "crawl_closure", "site_closure", "severity_route", "article_detail", "user_profile", "feed_links",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from webcorpus.plans.queries import QUERIES
    from webcorpus.session import build_session

    extra = {"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # stage/task times, read offline (no UI)
    if event_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    # the bench tables are one file of one row group each: deal the rows out to the cores
    extra["webcorpus.stage.partitions"] = str(cpus)
    spark = build_session(f"local[{cpus}]", app="webcorpus-bench", shuffle_partitions=cpus, extra=extra)
    # Untimed warm-up: every headline query once on the smallest tables
    # (different data, same code paths), so the timings below measure
    # steady-state throughput rather than JIT compilation and Python
    # worker start-up.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in HEADLINE:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    out = {"metric": "total_headline_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "spark": spark.version}
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
