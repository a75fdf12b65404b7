"""Time the headline queries and print one JSON line.

Every query is built from the raw tables each time (nothing is shared between
queries) and its whole result is computed into a sink that discards it.

    BENCH_SF_DIR   folder of the star schema   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores                 (default 8)
    BENCH_QUERIES  comma-separated names       (default: the headline list)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from slatecast.queries import QUERIES  # noqa: E402
from slatecast.session import get_session  # noqa: E402

HEADLINE = [
    "stg_pitches", "pitch_flags", "int_batter_game", "fct_batter_game", "fct_pitcher_game",
    "fct_batter_vs_pitcher", "fct_batter_pitchtype", "int_team_rolling", "rolling_hit_rate",
    "feat_batter_game", "feat_slate", "monthly_ic", "picker_table", "asof_last_purchase",
    "event_quantiles", "user_streaks", "stream_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session("bench", cores=cpus, **{"spark.sql.shuffle.partitions": cpus,
                                                "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()   # start-up is not a query
    times = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
