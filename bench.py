"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  input tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from tideledger.catalog import load
from tideledger.session import local_session

HEADLINE = (
    "d10_daily_twa",            # legs, all code kinds, daily balances
    "d10_ledger_wallet_days",   # balance intervals over 6.6 years
    "d13_window_with_opening",  # one window seeded with carried state
    "d8_rerouted_codes",
    "d6_delivery_codes",
    "d14_conversion_series",
    "d17_deployment_ratio",
    "d21_monthly_rewards",      # intervals to monthly rewards
    "d22_family_rewards",       # all families combined
    "d38_daily_rewards",
    "d39_sticky_program_months",
    "d23_rollup_detail",
    "w1_running_balance",
    "s2_decode_transfers",
)


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "12g"), app="bench")
    queries, _ = load()
    names = sys.argv[1:] or HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
    }))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
