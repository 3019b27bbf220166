"""Benchmark: run the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed in full with the ``noop`` sink (every row produced, nothing
collected to the driver), after one untimed warm-up of the JVM; it is repeated up to
``$BENCH_RUNS`` times (3), as long as its runs took less than ``REPEAT_SECONDS`` together,
and its median counts. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeloom.plans.index import QUERIES  # noqa: E402
from lakeloom.session import build_session  # noqa: E402

HEADLINE = [
    "monthly_stats_export", "monthly_stats_import", "consolidated", "report_by_year",
    "fact_export", "dim_product", "dim_establishment", "fact_establishment", "dim_partner",
    "region_rollup", "clean_text", "charset_repair", "latest_per_key", "dedup_key", "salt_advice",
    "csv_roundtrip", "csv_sanitized", "incremental_rows", "archive_lines",
]


REPEAT_SECONDS = 10.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    names = [n for n in HEADLINE if n in QUERIES]
    QUERIES["dim_month"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times, runs = {}, int(os.environ.get("BENCH_RUNS", "3"))
    for name in names:
        took: list[float] = []
        while not took or (len(took) < runs and sum(took) < REPEAT_SECONDS):
            t0 = time.perf_counter()
            QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(took), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
