"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

HEADLINE = [
    "f053_three_way_merge", "f055_status_precedence", "f101_funnel", "f098_latest_counts", "f099_stage_rollup", "f034_prune", "f064_latest_per_key", "f130_version_status",
    "f123_adjacent_versions", "f148_normalise", "f149_words", "f151_sentences", "f112_text_coverage", "f194_html_blocks", "f082_link_resolution", "f085_help_map_diff", "f129_greedy_packing", "f218_depth_first",
]


def main() -> None:
    from pyspark.sql import SparkSession

    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tessella.plans import registry

    took = {}
    for name in HEADLINE:
        if name not in registry.QUERIES:
            continue
        best = None
        for _ in range(2):  # the first run compiles
            began = time.time()
            registry.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            best = min(best or 1e9, time.time() - began)
        took[name] = round(best, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
