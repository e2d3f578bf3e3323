"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2 warm runs, the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "session_ohlcv", "realized_range_har", "premarket_features", "macro_features", "sma_distance",
    "bollinger_pct_b", "stochastic", "daily_technicals", "aligned_articles", "text_keys",
    "scores_on_copies", "daily_sentiment", "mean_embedding", "tail_flags", "range_band", "tone_label",
    "calendar_features", "days_to_event", "bars_incremental", "dedupe_highest_volume",
    "feature_matrix", "model_matrix", "training_matrix", "settlement", "forecast_report",
    "baseline_metrics", "fit_predict", "stream_sessions",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from openbell import recommended_conf
    from openbell.plans.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("openbell-bench")
    conf = recommended_conf() | {
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    wanted = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in wanted:
        try:
            times = []
            for _ in range(runs + 1):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - t0)
            seconds[name] = round(statistics.median(times[1:] or times), 3)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    result = {
        "metric": "headline queries, median warm wall time, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if "stream_sessions" in seconds:
        result["stream_rows_per_sec"] = round(rows / seconds["stream_sessions"])
    if failed:
        result["failed"] = failed
    print(json.dumps(result))


if __name__ == "__main__":
    main()
