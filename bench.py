"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line with the median seconds of warm runs."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

HEADLINES = ["count_children_topn", "rekey_join", "resolve_links", "leaf_scores", "top_leaves_per_node", "category_index_done", "ancestors_min_depth", "json_claims", "dump_roundtrip_page", "line_shards"]


def main() -> None:
    from lorewell.plans import catalogue

    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3")) + 1):
            began = time.time()
            catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        seconds[name] = round(statistics.median(runs[1:]), 3)  # the first run warms up
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
