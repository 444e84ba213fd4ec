"""Benchmark: one full refresh, stage by stage, and each report table on its own.

Prints one JSON line. ``value`` is a whole refresh from raw CSV to all 32 written tables. The stages
are also timed one after the other, and report tables and operators alone. Times are medians of
repeated runs after warm-up runs; ``cold`` is the first run of a new session.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from checks.build import built, raw_files
from checks.catalog import QUERIES
from revisit.plans import kpis, refresh
from revisit.session import fresh_folder, local_session

SINGLE = [
    *kpis.TABLES, *refresh.QUALITY_TABLES, "clean_sequence", "clean_bounds", "fact_encounter", "fact_medication_join",
    "measures_by_slicer", "drug_measures_under_filter", "admission_by_stay", "reconcile_differences",
    "segment_rates", "top_parts", "customer_utilisation", "quantity_fences",
]


def timed(action: Callable[[], object]) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    raw = raw_files(spark, sf_dir)

    def whole() -> float:
        return timed(lambda: refresh.refresh(spark, *raw, fresh_folder(spark)))

    def by_stage() -> dict[str, float]:
        root, tables, seconds = fresh_folder(spark), {}, {}
        seconds["staging"] = timed(lambda: tables.update(refresh.stage(spark, *raw, root)))
        for name, step in refresh.STAGES.items():
            seconds[name] = timed(lambda step=step: step(tables, root))
        return seconds

    cold = whole()
    for _ in range(5):
        whole()
    total = statistics.median(whole() for _ in range(repeats))
    runs = [by_stage() for _ in range(repeats)]
    seconds = {name: statistics.median(run[name] for run in runs) for name in runs[0]}

    encounters = built(spark, sf_dir)["stg_encounters"].count()
    for name in SINGLE:
        run = lambda name=name: QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        run()
        seconds[name] = statistics.median(timed(run) for _ in range(repeats))

    print(
        json.dumps(
            {
                "metric": "full refresh, raw CSV to 32 tables",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "cold": round(cold, 3),
                "raw_rows": encounters,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
