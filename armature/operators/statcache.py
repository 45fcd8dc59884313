"""Statistics that are computed once per (dataset, spec) and found again by key."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armature.operators.statistics import dataset_statistics


def cache_keys(steps: DataFrame, state_keys: str, recipe: str) -> DataFrame:
    """dataset_name, cache_key: a hash over everything the statistics depend on besides the rows."""
    spec = F.concat_ws("|", F.col("dataset_name"), F.lit(state_keys), F.lit(recipe))
    return steps.select("dataset_name").distinct().select("dataset_name", F.sha2(spec, 256).alias("cache_key"))


def cached(spark, path: str) -> DataFrame | None:
    """What is there; None if nothing was written yet. Any other trouble with the cache is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def statistics_with_cache(steps: DataFrame, path: str, state_keys: str, recipe: str) -> DataFrame:
    """Compute and append what the cache at `path` lacks, then return the wanted rows with `was_cached`."""
    spark = steps.sparkSession
    wanted = cache_keys(steps, state_keys, recipe)
    known = cached(spark, path)
    missing = wanted if known is None else wanted.join(known.select("cache_key"), "cache_key", "left_anti")
    todo = steps.join(missing.select("dataset_name"), "dataset_name", "left_semi")
    fresh = dataset_statistics(todo).join(missing, "dataset_name")
    fresh.write.mode("append").parquet(path)
    hits = None if known is None else known.select("cache_key", F.lit(True).alias("was_cached"))
    found = spark.read.parquet(path).join(wanted, ["dataset_name", "cache_key"])
    if hits is None:
        return found.withColumn("was_cached", F.lit(False))
    # `known` lists the files as they were before the append
    return found.join(hits, "cache_key", "left").withColumn("was_cached", F.coalesce("was_cached", F.lit(False)))
