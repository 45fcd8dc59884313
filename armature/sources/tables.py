"""Readers of the canonical tables. Column pruning and filters reach the parquet scan because nothing here is opaque."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.sources.jsonarray import RANGE_BYTES, array_objects

CHAT_EXAMPLE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("part", T.LongType()),  # null in files of other writers: the whole conversation
        T.StructField("image", T.StringType()),
        T.StructField(
            "conversations",
            T.ArrayType(T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())])),
        ),
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One supplied table. How finely it is scanned is up to its row groups and `spark.sql.files.maxPartitionBytes`."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def episodes(spark: SparkSession, path: str, dataset: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A steps table partitioned by dataset_name; naming the dataset prunes the other partitions.

    With a schema given, a table that nobody has written rows to is read as an empty one.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    steps = reader.parquet(path)
    return steps if dataset is None else steps.filter(steps.dataset_name == dataset)


def chat_examples(spark: SparkSession, path: str, json_array: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Annotation JSON: files of one array each, the interchange format, cut into byte ranges; or JSON lines."""
    if not json_array:
        return spark.read.schema(CHAT_EXAMPLE).json(path)
    found = array_objects(spark, path, range_bytes=range_bytes)
    return found.select(F.from_json("value", CHAT_EXAMPLE).alias("e")).select("e.*")


_NUMBERS = "mean: array<double>, std: array<double>, min: array<double>, max: array<double>, q01: array<double>, q99: array<double>"
STATISTICS_FILE = f"map<string, struct<action: struct<{_NUMBERS}, mask: array<boolean>>, proprio: struct<{_NUMBERS}>, num_transitions: bigint, num_trajectories: bigint>>"


def saved_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Saved statistics, a row per dataset. A `.json` path is the interchange file: one object keyed by dataset."""
    if not path.endswith(".json"):
        return spark.read.parquet(path)
    whole = spark.read.text(path, wholetext=True).filter(F.trim("value") != "")
    entries = whole.select(F.explode(F.from_json("value", STATISTICS_FILE)).alias("dataset_name", "s"))
    return entries.select("dataset_name", "s.*")


def metric_log(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
