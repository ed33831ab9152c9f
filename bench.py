"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINES = [
    "dedup_ratings",
    "similar_pairs_exact",
    "similar_pairs_lsh",
    "minhash_signatures",
    "lsh_candidates",
    "lsh_stats",
    "item_cf_model",
    "user_cf_model_exact",
    "user_cf_model_lsh",
    "item_cf_predict",
    "user_cf_predict",
    "word_counts",
    "business_profiles",
    "user_profiles",
    "content_predict",
]


def main(scratch: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("kindred-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus) if cpus.isdigit() else 16))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["user_rating_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the engine
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="kindred-bench-") as folder:
        main(folder)
