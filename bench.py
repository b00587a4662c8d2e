"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs once
to warm up and is then timed to its last row through a sink that keeps nothing.

The given tables are one file of one row group each, which a single task reads. Before
anything is timed they are copied to as many files as there are cores, as tables of any
size lie on a cluster; the library itself never moves a table for that.
"""

from __future__ import annotations

import glob
import json
import os
import shutil
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from newsprep.plans.catalog import QUERIES
from newsprep.session import RECOMMENDED

HEADLINE = (
    "content_fingerprint",
    "dedup_keep_first",
    "dedup_report",
    "seeded_sample",
    "stratified_split",
    "split_leakage",
    "fit_article_char",
    "fit_article_word",
    "format_sft",
    "tokenize_batches",
    "parse_summary",
    "rouge_l",
    "prediction_records",
    "metrics_report",
    "error_slices",
    "review_queue",
    "compare_runs",
    "run_registry",
    "config_diff",
    "stream_parse_failures",
    "holdout_report",
    "fingerprint_drift",
    "score_prompts",
    "stream_sessions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="bench-")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = RECOMMENDED | {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": f"{scratch}/shared",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tables = f"{scratch}/tables"
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        copy = f"{tables}/{os.path.basename(path)}"
        spark.read.parquet(path).repartition(int(cpus)).write.parquet(copy)

    seconds = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)


if __name__ == "__main__":
    main()
