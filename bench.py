"""Times the headline queries once each, after a warm-up, and prints one JSON line."""

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from plumbline.workloads.queries import QUERIES

HEADLINE = (
    "profile_nulls", "profile_distinct", "profile_numeric", "profile_top_values", "infer_types",
    "discover_relationships", "check_iqr_outliers", "check_duplicate_rows", "check_orphans",
    "check_date_gaps", "check_benford", "remediate_ffill_rows", "remediate_unmapped",
    "remediate_keep_latest", "asof_rates", "measure_exposure", "measure_portfolio_value",
    "findings_all", "quality_run",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plumbline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["profile_tables"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
