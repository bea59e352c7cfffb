"""Time the headline queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma separated names) choose the
data, the cores and the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ratinglens.session import local_session
from workload.registry import all_queries

HEADLINE = (
    "cleaned_entities",
    "quality_report",
    "cleaned_comments",
    "comment_metrics",
    "latest_snapshot",
    "shrunk_scores",
    "average_ranks",
    "spearman",
    "entity_quadrants",
    "quadrant_sensitivity",
    "yearly_category_share",
    "category_origin_table",
    "origin_statistics",
    "tag_coverage",
    "rank_limited_sample",
    "progress_spine",
    "pending_entities",
    "failure_states",
    "page_outcomes",
    "detail_payloads",
    "clean_texts",
    "score_density",
    "star_measure_boxes",
    "analysis_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "")
    spark = local_session(cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    chosen = [n for n in names.split(",") if n] or HEADLINE
    # the first query pays for class loading and the file listing
    queries["latest_snapshot"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in chosen:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "headline_total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
