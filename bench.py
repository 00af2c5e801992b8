"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and once for the clock, building included, its rows going to the noop sink.
Names given as arguments choose other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from swaplens.checks import QUERIES
from swaplens.session import local_session

HEADLINE = [
    "pair_summary",
    "top_pairs",
    "top_traders",
    "enriched_swaps",
    "skipped_swaps",
    "run_stats",
    "daily_token_agg",
    "normalized_swaps",
    "validated_swaps_negative_out",
    "deduped_swaps",
    "unique_tokens",
    "after_block",
    "swap_pages_parsed",
    "rolling_volume",
    "rolling_volume_by_symbol",
    "rolling_swap_volume",
    "sliding_rate",
    "flagged_outliers",
    "tick_direction",
    "estimated_quotes_sticky",
    "pnl_sign_flips",
    "feed_gaps",
    "feed_sessions",
    "latest_tick",
    "valued_positions",
    "pair_summary_by_window",
    "streamed_pair_summary",
    "live_ticks",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    chosen = sys.argv[1:] or [name for name in HEADLINE if name in QUERIES]
    times = {}
    for name in chosen:
        seconds(spark, name, sf_dir)
        times[name] = round(seconds(spark, name, sf_dir), 3)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
