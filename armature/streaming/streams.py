"""Streams: training frames as step files arrive, success counters. What needs time order is in `ordered`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.functions import vectors as V
from armature.operators import tokens as K
from armature.operators.statistics import normalize
from armature.sources.sinks import scratch


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, name: str, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files of a folder as they arrive; the number of files per micro-batch bounds its size."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", name)
        .parquet(folder)
    )


def run_to_end(stream: DataFrame, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything that is there now, then stop. Progress is kept on shared storage."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", scratch(stream.sparkSession, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """One folder per micro-batch, overwritten on replay: a batch that is run again does not appear twice."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def newest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last answer for each key among the updates that `append_batches` wrote: nothing is replaced in place."""
    rest = [c for c in updates.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*rest), F.col("batch").cast("long")).alias("__last")
    return updates.groupBy(*keys).agg(last).select(*keys, "__last.*")


def token_frames(steps: DataFrame, stats: DataFrame, how: str, action_dim: int, mask: list[bool], keys: list[str]) -> DataFrame:
    """Stateless: normalize with a static table of statistics, discretize, tokenize. Works on streams and tables."""
    normalized = normalize(steps, stats, how, action_dim, 0, mask)
    frames = normalized.select(
        *keys,
        "dataset_name",
        F.struct("language_instruction").alias("task"),
        F.array(F.struct("image_primary")).alias("observation"),
        F.array(V.each("action", action_dim, lambda x, _: x)).alias("action"),
    )
    return K.action_examples(frames, keys, action_dim)


def success_counters(rollouts: DataFrame) -> DataFrame:
    return rollouts.groupBy("task").agg(
        F.count(F.lit(1)).alias("n_episodes"), F.sum(F.col("success").cast("long")).alias("n_successes")
    )
