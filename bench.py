"""Benchmark: headline analyses at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each analysis is executed completely through the ``noop`` sink (the whole
plan runs, nothing is collected), once as warm-up and then $BENCH_REPS
times; the median is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aulaframe.plans.registry import load_all  # noqa: E402
from aulaframe.session import get_spark, input_bytes, shuffle_partitions_for  # noqa: E402
from aulaframe.sources.tables import TABLES  # noqa: E402

HEADLINE = [
    "group_stats_ordinal", "describe_modules", "box_stats", "box_by_group", "corr_matrix",
    "effect_size_eta2", "percentile_national", "percentile_core", "crosstab_margins",
    "chi_square_stat", "dedup_latest", "fact_scores", "star_rollup", "star_integrity",
    "variable_dictionary", "budget_columns", "monthly_flow", "counts_rollup", "rename_plan",
    "famd_explained",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_spark(f"local[{cpus}]", app="aulaframe-bench", shuffle_partitions=2 * cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # shuffle partitions sized from the input volume (AQE coalesces the rest)
    data = input_bytes(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES])
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions_for(data, cpus)))
    reg = load_all()
    names = only or HEADLINE
    times = {}
    for name in names:
        a = reg[name]
        runs = []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            a.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
