"""Time the headline queries: prints one JSON line, seconds per query (median of the runs)."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import inputs  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "csv_day_scan", "shop_mapping", "stage_mapped", "parse_fix_date", "row_index_per_file",
    "row_index_split_files", "receipts_valid", "receipts_errors", "stage_counts", "import_receipts",
    "history_extract", "csv_shop_scan", "history_extract_daily", "parse_weekday", "receipts_errors_ranked",
]
RUNS = 3


def write_inputs_once() -> None:
    """The raw files of a query are written before its clock starts, and taken as they are after that."""
    write, written = inputs.raw_files, {}

    def raw_files(spark: SparkSession, sf_dir: str, **options) -> str:
        key = (sf_dir, *sorted(options.items()))
        if key not in written:
            written[key] = write(spark, sf_dir, **options)
        return written[key]

    inputs.raw_files = raw_files


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    write_inputs_once()
    inputs.raw_files(spark, sf_dir)
    inputs.raw_files(spark, sf_dir, sep=";")
    inputs.raw_files(spark, sf_dir, per_shop=True)
    seconds, jobs = {}, {}
    for name in HEADLINE:
        runs = []
        for run in range(RUNS):
            spark.sparkContext.setJobGroup(f"{name}-{run}", name)
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{name}-{RUNS - 1}"))
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "runs": RUNS, "statistic": "median",
        "jobs": jobs}))


if __name__ == "__main__":
    main()
