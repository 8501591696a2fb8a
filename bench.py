"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsloom.plans.queries import QUERIES
from newsloom.session import build_session

HEADLINES = [
    "graph_role_counts",
    "star_join",
    "graph_pruned",
    "graph_pruned_nodes",
    "entities_unnest",
    "unique_actors",
    "canonical_names",
    "per_date_ids",
    "events_by_date",
    "merged_sources",
    "sources_dim",
    "actors_dim",
    "narrative_graph",
    "dates_gregorian",
    "dates_bs",
    "text_dates",
    "page_content",
    "page_articles",
    "parse_responses",
    "prompts_merge",
    "merge_events",
    "components",
    "resolve_aliases",
    "extract_baseline",
    "sink_dated_events",
    "stream_once_per_id",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "newsloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["unique_event_labels"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "headline queries, total wall-clock",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
