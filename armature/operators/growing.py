"""Statistics that grow with their datasets: new episodes are read once and added to what is known.

What is kept of each dataset and batch of new episodes is a row of sizes, moments, extremes and a quantile sketch per dimension;
batches are merged when they are read. Moments and extremes are those of all rows. Quantiles are those of the merged sketch: its
rank error shrinks with `k` (about 0.13 % at 4096) and does not grow with rows or batches; up to `k` values they are exact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armature.functions import vectors as V
from armature.operators.statistics import PROBABILITIES, with_proprio

SKETCH_K = 4096
#: Share of ranks by which a quantile of the sketch may be off: three times its usual error.
RANK_SLACK = 0.004


def partial_statistics(steps: DataFrame, widths: Mapping[str, int], k: int = SKETCH_K) -> DataFrame:
    """One row per dataset from one scan, aggregated before the shuffle; vectors are not taken apart into rows.

    `steps` holds whole episodes with a `timestep`; an episode is counted at its step 0. `widths` gives the largest width of
    each vector; what a narrower dataset lacks has no values. Nulls are left out.
    """
    steps, pieces = with_proprio(steps), []
    for key, width in widths.items():
        for i in range(width):
            v = F.get(V.doubles(key), F.lit(i))
            pieces.append(
                F.struct(
                    F.lit(key).alias("key"), F.lit(i).alias("dim"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("var"),
                    F.min(v).alias("min"), F.max(v).alias("max"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"),
                )
            )
    return steps.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("num_transitions"), F.count_if(F.col("timestep") == 0).alias("num_trajectories"), F.array(*pieces).alias("dims")
    )


def add_episodes(steps: DataFrame, path: str, batch: str, widths: Mapping[str, int], k: int = SKETCH_K) -> None:
    """Keep the statistics of a batch of new episodes. A batch that is added again replaces itself."""
    partial_statistics(steps, widths, k).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def merged(parts: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Long form of the parts together: dataset_name, key, dim, n, mean, std, min, max, q01, q99, sketch.

    There is one narrow row per dataset, batch and dimension. Means of parts are brought together by their distance from the
    common mean, so large offsets do not cancel.
    """
    group = ["dataset_name", "key", "dim"]
    rows = parts.select("dataset_name", F.inline("dims")).filter("n > 0")
    whole = rows.groupBy(*group).agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
    )
    centres = whole.select(*group, F.col("mean").alias("__centre"))
    apart = F.col("mean") - F.col("__centre")
    spread = rows.join(centres, group).groupBy(*group).agg((F.sum(F.col("n") * (F.col("var") + apart * apart)) / F.sum("n")).alias("__var"))
    quantiles = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in PROBABILITIES]))
    return whole.join(spread, group).withColumn("__q", quantiles).select(
        *group, "n", "mean", F.sqrt("__var").alias("std"), "min", "max", F.col("__q")[0].alias("q01"), F.col("__q")[1].alias("q99"), "sketch"
    )


def grown_statistics(spark: SparkSession, path: str, k: int = SKETCH_K) -> DataFrame:
    """Statistics of everything that was added at `path`, in long form."""
    return merged(spark.read.parquet(path), k)


def grown_sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).groupBy("dataset_name").agg(
        F.sum("num_transitions").alias("num_transitions"), F.sum("num_trajectories").alias("num_trajectories")
    )


def compact(spark: SparkSession, path: str, into: str, k: int = SKETCH_K) -> None:
    """All batches at `path` as one batch of a new folder, after which fewer rows are read."""
    dims = F.collect_list(F.struct("key", "dim", "n", "mean", (F.col("std") * F.col("std")).alias("var"), "min", "max", "sketch"))
    long = grown_statistics(spark, path, k).groupBy("dataset_name").agg(dims.alias("dims"))
    sizes = grown_sizes(spark, path)
    sizes.join(long, "dataset_name").select("dataset_name", "num_transitions", "num_trajectories", "dims").write.parquet(f"{into}/batch=0")
