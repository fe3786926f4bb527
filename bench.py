"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` (optional, comma separated) a choice of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from billstream.plans.registry import load_catalog  # noqa: E402
from billstream.session import build_session  # noqa: E402

HEADLINE = [
    "feed_latest_activity",
    "feed_top_n",
    "routine_filter",
    "join_log_bill",
    "join_multi",
    "link_event_bill",
    "merge_actions",
    "incremental_bills",
    "incremental_votes_events",
    "orphan_state",
    "bills_summary",
    "classification_histogram",
    "last_write_wins",
    "per_repo_limit",
    "flat_log_names",
    "snapshot_manifest",
    "keyword_tags",
    "tag_job",
    "semantic_tags",
    "mean_pool",
    "html_to_text",
    "pdf_lines_structure",
    "strike_text",
    "extract_batch",
    "scrape_summary",
    "daily_activity",
    "q_session_coverage",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = load_catalog()

    def run(name: str) -> float:
        start = time.perf_counter()
        # The noop sink computes every row and column without collecting them.
        catalog[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        run(name)
        times[name] = round(min(run(name) for _ in range(2)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
