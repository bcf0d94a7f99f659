"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

Each query is run BENCH_RUNS times (three by default) after one warm-up run and the median
counts. The whole result is computed and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataflow.queries import QUERIES

HEADLINE = [
    "q_csv_scan",
    "q_csv_typed",
    "q_csv_documents",
    "q_json_decode",
    "q_onehot_fit",
    "q_minmax_fit",
    "q_feature_assemble",
    "q_onehot_names",
    "q_features_lineitem",
    "q_vectors",
    "q_vectors_many",
    "q_label_join",
    "q_label_join_frequent",
    "q_gold_join",
    "q_gold_join_frequent",
    "q_gold_in_place",
    "q_split",
    "q_score",
    "q_accuracy",
    "q_train",
    "q_job_features",
    "q_job_gold",
    "q_job_gold_in_place",
    "q_stream_bronze",
    "q_stream_gold",
    "q_stream_gold_batches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    # this session is one process on one machine; what it writes goes when it ends
    with tempfile.TemporaryDirectory(prefix="bench-", dir=os.environ.get("BENCH_SCRATCH")) as scratch:
        seconds = measure(sf_dir, cpus, runs, scratch)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


def measure(sf_dir: str, cpus: str, runs: int, scratch: str) -> dict[str, float]:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    return seconds


if __name__ == "__main__":
    main()
