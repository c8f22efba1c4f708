"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tidepanel.queries import queries

HEADLINE = [
    "panel_slice", "ma_features", "bollinger", "ewm_macd", "momentum", "rolling_rank_pct", "xs_rank_pct", "asof_revenue", "feature_merge",
    "label_up20", "triple_barrier", "score_exit_trades", "equity_curve", "threshold_curve", "pattern_stats", "unexplained_jumps", "trendline_envelope",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, seconds = queries(), {}
    known["panel_slice"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # compile and read once before timing
    for name in HEADLINE:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "panel_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
