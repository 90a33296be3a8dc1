"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. ``--rewrites`` times the plain shape of the
rewritten models next to the shape in use, ``--all`` every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.registry import QUERIES  # noqa: E402
from harness.rewrites import REWRITES  # noqa: E402
from harness.testdata import warehouse  # noqa: E402
from vitrine.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "stg_purchases",
    "stg_client_events",
    "int_purchases_with_fx",
    "int_game_prices_replayed",
    "int_users_campaign_attribution",
    "dim_game_prices",
    "fct_purchases",
    "fct_refunds",
    "fct_playtime_sessions",
    "fct_dbt_test_results",
    "fct_source_freshness",
    "fct_finance_revenue_daily",
    "fct_finance_capacity_daily",
    "fct_marketing_signups_daily",
    "fct_marketing_campaign_cpa",
    "fct_marketing_campaign_revenue",
    "fct_product_active_users_daily",
    "fct_product_session_length_daily",
    "fct_product_wishlist_conversion",
    "fct_product_funnel_sessions",
    "assert_dim_game_prices_gapless_coverage",
    "assert_fct_product_funnel_sessions_stages_monotonic",
    "assert_fct_product_wishlist_conversion_logic",
    "scd2_replay_order_totals",
    "cohort_percentiles_of_quantities",
    "signed_daily_of_lineitem",
    "source_freshness",
]


def timed(build) -> float:
    """Median seconds of a full run into a sink that discards rows, after one run to warm up."""
    seconds = []
    for _ in range(RUNS + 1):
        started = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS), memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    # Neither the first query's classes nor its compiled code should count as its work.
    QUERIES["fct_finance_revenue_daily"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    times = {}
    if "--rewrites" in sys.argv:
        for name, (plain, used) in REWRITES.items():
            times[f"{name}_plain"] = timed(lambda: plain(warehouse(spark, SF_DIR)))
            times[f"{name}_used"] = timed(lambda: used(warehouse(spark, SF_DIR)))
    else:
        for name in QUERIES if "--all" in sys.argv else HEADLINE:
            times[name] = timed(lambda: QUERIES[name](spark, SF_DIR))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
