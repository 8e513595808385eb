"""Time the headline queries: one JSON line with the seconds per query (best of two runs after a warm-up; streams: one run after a warm-up).

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` (comma separated) other
queries than the headline ones, ``all`` for every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "word_count",
    "parse_delimited",
    "parse_json_drop_bad",
    "side_output_route",
    "rolling_sum",
    "rolling_sum_split",
    "rolling_max_by",
    "ad_counts_running",
    "ad_counts_sql",
    "grand_total_income",
    "grand_total_income_split",
    "salted_sum",
    "sql_group_sum",
    "retract_changelog",
    "count_window_all_sum",
    "count_window_keyed",
    "tumble_keyed",
    "tumble_collect",
    "slide_keyed",
    "session_all",
    "session_keyed",
    "window_aggregate_history",
    "late_data_split",
    "state_value_ttl",
    "state_list_last10",
    "state_list_ttl",
    "state_list_ttl_split",
    "timer_topn_per_key",
    "hot_items_topn",
    "window_join_left",
    "window_cogroup",
    "interval_join",
    "broadcast_dim_join",
    "lookup_join_default",
    "geo_enrich",
    "range_lookup",
    "udtf_split",
    "stream_word_count",
    "stream_tumble_keyed",
    "stream_rolling_sum",
]


def main() -> None:
    from rillstone.plans import QUERIES
    from rillstone.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in names:
        runs = 2 if name.startswith("stream_") else 3
        taken = [timed(name) for _ in range(runs)]
        seconds[name] = round(min(taken[1:] or taken), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
