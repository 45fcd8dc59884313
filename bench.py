"""Time the headline jobs and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each job is run to a sink that discards its rows; the
first job is run once before the clock starts, so that JVM start-up is not part of anybody's time.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from armature.plans import catalogue

HEADLINE = [
    "add_timestep",
    "standardize_dispatch",
    "noop_filter",
    "dataset_statistics",
    "approx_statistics",
    "normalize_bounds_q99",
    "goal_relabel_uniform",
    "chunk_actions",
    "trajectory_transforms",
    "mixture_weights",
    "sample_from_datasets",
    "shuffle_frames",
    "interleaved_mixture",
    "discretize_action",
    "batch_transform",
    "build_chat_prompt",
    "turn_tokens_with_labels",
    "modality_lengths",
    "split_modality_batches",
    "length_bucket_assign",
    "merge_and_order_batches",
    "assign_replicas",
    "check_batch_cover",
    "distributed_sampler",
    "pad_collate_lm",
    "pad_collate_action",
    "action_l1",
    "rolling_metrics",
    "running_success",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    run(HEADLINE[0])
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline jobs, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
