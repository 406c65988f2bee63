"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfcast import catalog  # noqa: E402
from shelfcast.session import build_session, release  # noqa: E402

HEADLINES = [
    "sales_by_day",
    "analytic_table",
    "profile_columns",
    "numeric_summary",
    "clean_table",
    "season_month",
    "rolling_features",
    "features_full",
    "target_encode",
    "encoded_table",
    "mutual_information",
    "train_per_series",
    "score_one_day",
    "recursive_forecast",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)

    def timed(query: Callable) -> float:
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    timed(catalog.QUERIES["src_tables"])  # starts the JVM's worker threads
    # Training is timed with everything it needs; scoring and forecasting then load
    # the registry it left, as they do in use.
    catalog.forget_trained()
    seconds = {name: timed(catalog.QUERIES[name]) for name in HEADLINES}
    release(spark)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
