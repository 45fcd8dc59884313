"""Writers: statistics JSON, filtered demos, rollouts, metric logs, frame shards. Each is one distributed write."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from armature.operators.episodes import in_parts
from armature.operators.smallside import shared_folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_statistics(stats: DataFrame, path: str) -> None:
    """The interchange file: one JSON object keyed by dataset. It has a short entry per dataset, so it is one line."""
    entry = F.struct("dataset_name", F.struct(*[c for c in stats.columns if c != "dataset_name"]).alias("s"))
    whole = stats.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value"))
    whole.coalesce(1).write.mode("overwrite").text(path)


def write_demos(steps: DataFrame, path: str) -> None:
    steps.write.mode("overwrite").partitionBy("dataset_name").parquet(path)


def write_rollouts(steps: DataFrame, path: str, columns: Sequence[str], rows: int = 1024) -> None:
    """One row per (episode, part) of at most `rows` steps, so no list grows with its episode."""
    in_parts(steps, columns, rows=rows).write.mode("overwrite").parquet(path)


def write_episode_metainfo(rollouts: DataFrame, path: str) -> None:
    """task key, demo key, success, initial state: one JSON line each, a folder per task."""
    rollouts.write.mode("overwrite").partitionBy("task_key").json(path)


def append_metrics(records: DataFrame, path: str, header: DataFrame | None = None, header_path: str | None = None) -> None:
    """Append flat JSON records with their keys in sorted order; the run header goes to its own file."""
    records.select(*sorted(records.columns)).write.mode("append").json(path)
    if header is not None:
        header.select(*sorted(header.columns)).write.mode("append").json(header_path)


def in_shards(rows: DataFrame, rows_per_shard: int, position: str) -> DataFrame:
    """Rows of consecutive positions together in one task, in order, with their `shard`."""
    sharded = rows.withColumn("shard", F.floor(F.col(position) / rows_per_shard).cast("long"))
    return sharded.repartition("shard").sortWithinPartitions("shard", position)


def write_frame_shards(frames: DataFrame, path: str, rows_per_shard: int, position: str = "position") -> None:
    """Frames in `position` order, one file per shard of `rows_per_shard` rows, and a manifest.

    `path`/shards holds a folder per shard; `path`/manifest one JSON line per file with its shard, rows and positions.
    """
    in_shards(frames, rows_per_shard, position).write.mode("overwrite").partitionBy("shard").parquet(f"{path}/shards")
    file = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/[^/]+)$", 1).alias("file")
    written = frames.sparkSession.read.parquet(f"{path}/shards").select("shard", F.col(position).alias("__p"), file)
    manifest = written.groupBy("shard", "file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("__p").alias("first_position"), F.max("__p").alias("last_position")
    )
    manifest.write.mode("overwrite").json(f"{path}/manifest")


def shard_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("shard long, file string, n_rows long, first_position long, last_position long").json(f"{path}/manifest")


def write_json_arrays(rows: DataFrame, path: str, rows_per_file: int, position: str = "position") -> None:
    """The interchange form of examples: files of one JSON array each, an object per line, in `position` order."""
    objects = rows.select(position, F.to_json(F.struct(*[c for c in rows.columns if c != position])).alias("__o"))
    sharded = in_shards(objects, rows_per_file, position)
    place = Window.partitionBy("shard").orderBy(position)
    opening = F.when(F.lag(position).over(place).isNull(), "[").otherwise("")
    closing = F.when(F.lead(position).over(place).isNull(), "]").otherwise(",")
    lines = sharded.select("shard", position, F.concat(opening, "__o", closing).alias("value")).sortWithinPartitions("shard", position)
    lines.select("shard", "value").write.mode("overwrite").partitionBy("shard").text(path)


def write_corpus(corpus: DataFrame, path: str, rows_per_file: int = 100_000, position: str = "position") -> None:
    """A shuffled corpus as JSON lines: files follow each other in `position` order, and so do the lines inside them."""
    (
        corpus.repartitionByRange(position)
        .sortWithinPartitions(position)
        .drop(position)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .json(path)
    )
