"""Times headline queries on BENCH_SF_DIR with local[BENCH_CPUS]; prints one JSON line.

Each query is materialized into the `noop` sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowledger.plans.queries import QUERIES  # noqa: E402
from flowledger.session import local_session  # noqa: E402

HEADLINE = [
    "numeric_text_clean", "merge_duplicates", "silver_issues", "silver_clean", "calendar_cumulative",
    "normalized_periods", "peak_segment", "loglinear_fit", "curve_fits", "model_choice", "forecast_points",
    "forecast_summary", "forecast_rows", "combined", "extend_forecast", "row_hash_changes", "numeric_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    # Start the JVM paths and the Python workers before the clock runs.
    for warm in ("silver_clean", "curve_fits"):
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
