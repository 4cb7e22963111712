"""Time the headline queries, each in its second run; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data, BENCH_CPUS (default 8) the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riverdeck.catalog import ENTRIES  # noqa: E402
from riverdeck.session import build_session  # noqa: E402

HEADLINE = [
    "randomness_report", "chi_squared_cards", "card_frequency", "timeline_chi_squared", "distribution_over_time",
    "community_sequences", "card_dedupe", "duplicate_seeds", "seed_characters", "total_hands_summary", "hands_page",
    "hand_details", "player_stats", "player_api_stats", "player_recent_actions", "leaderboard_profit",
    "leaderboard_monthly", "vip_tier_changes", "play_style", "scan_gaps", "decode_block_events", "cards_explode",
    "hands_fold", "results_fold", "sessions_fold", "state_asof", "hands_fold_legacy", "stream_hands_fold",
    "stream_sessions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "riverdeck-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for name in names:  # start-up, compilation and staged JSON outside the clock
        ENTRIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begun = time.perf_counter()
        ENTRIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
