"""Time the star build and the headline queries; prints one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the local cores. Each query runs
three times on the stored marts and its average is reported, as the published
baseline does.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from wardmart.plans.registry import QUERIES
from wardmart.plans.star import Star
from wardmart.session import local_session, table_root
from wardmart.sources.projections import AS_OF, raw_tables
from wardmart.sources.store import TableStore

RUNS = 3
HEADLINE = ("bq1_bench", "bq2_bench", "bq3_bench", "bq4_bench", "bq5_conversion_guard")
OTHERS = (
    "bq1_trend",
    "bq1_data_window",
    "bq2_rank_cross",
    "bq3_los_all",
    "bq4_department_load",
    "bq5_conversion_full",
    "join_nearest_match",
    "dq_summary",
    "dbt_relationships",
)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def average(build, star: Star) -> float:
    def once() -> None:
        df: DataFrame = build(star)
        df.collect()

    return sum(timed(once) for _ in range(RUNS)) / RUNS


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    star = Star(raw_tables(spark, sf_dir), TableStore(spark, table_root(spark)), as_of=AS_OF)

    seconds = {"star_build": timed(star.build)}
    QUERIES["report_status_distribution"](star).collect()
    for name in HEADLINE + OTHERS:
        if name == "join_nearest_match":
            seconds[name] = timed(lambda: QUERIES[name](star).write.format("noop").mode("overwrite").save())
        else:
            seconds[name] = average(QUERIES[name], star)

    print(
        json.dumps(
            {
                "metric": "star build plus five business questions",
                "value": round(seconds["star_build"] + sum(seconds[q] for q in HEADLINE), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
