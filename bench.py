"""Headline queries, timed: one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8).
Each query runs twice; the second time counts. Results are written to the no-op sink,
so every row and column is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plotwright.checks import queries  # noqa: E402
from plotwright.session import build_session, drop_work  # noqa: E402

HEADLINES = [
    "daily_load",
    "load_summary",
    "price_changes",
    "new_sellers",
    "layer_sync",
    "upsert_columns",
    "silver_transfer",
    "standardize_captioned",
    "standardize_titled",
    "address_parse",
    "accent_fold",
    "photo_links",
    "fuzzy_top1",
    "partial_top1",
    "region_cascade",
    "city_cascade",
    "street_match",
    "near_pairs_64",
    "near_pairs_16",
    "knn_pairs",
    "dup_counts",
    "distinct_on",
    "batches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="plotwright-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        for _ in range(2):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
            drop_work(spark)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
