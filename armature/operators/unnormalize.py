"""Predicted actions back to robot units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.operators.smallside import pin_small


def resolve_keys(requests: DataFrame, stats: DataFrame, key: str = "unnorm_key", suffix: str = "_no_noops") -> DataFrame:
    """Find the statistics of each request: its key, else the key with `suffix`. A request without key is fine only when
    there is a single dataset; an unknown key fails the job. Adds `resolved_key`, `action_stats`, `action_dim`."""
    names = [r[0] for r in stats.select("dataset_name").distinct().limit(2).collect()]
    only = names[0] if len(names) == 1 else None
    wanted = F.coalesce(F.col(key), F.lit(only)) if only else F.col(key)
    plain = stats.select(F.col("dataset_name").alias("__k1"), F.col("action").alias("__s1"))
    variant = stats.select(F.col("dataset_name").alias("__k2"), F.col("action").alias("__s2"))
    joined = (
        requests.withColumn("__key", wanted)
        .join(pin_small(plain), F.col("__key") == F.col("__k1"), "left")
        .join(pin_small(variant), F.concat(F.col("__key"), F.lit(suffix)) == F.col("__k2"), "left")
    )
    found = F.coalesce("__k1", "__k2")
    unknown = F.raise_error(F.concat(F.lit("no statistics for "), F.coalesce(F.col("__key"), F.lit("a missing key"))))
    out = joined.withColumn("resolved_key", F.when(found.isNotNull(), found).otherwise(unknown))
    out = out.withColumn("action_stats", F.coalesce("__s1", "__s2"))
    return out.withColumn("action_dim", F.size("action_stats.q01")).drop("__key", "__k1", "__k2", "__s1", "__s2")


def with_mask(stats: DataFrame, mask: list[bool]) -> DataFrame:
    """Attach the per-dimension normalization mask to the action statistics; lengths must agree."""
    literal = F.array(*[F.lit(bool(b)) for b in mask])
    wrong = F.raise_error(F.lit("normalization mask: wrong length")).cast("array<boolean>")
    fits = F.size("action.mean") == len(mask)
    return stats.withColumn("action", F.col("action").withField("mask", F.when(fits, literal).otherwise(wrong)))


def unnormalize(rows: DataFrame, vector: str, action_dim: int, out: str = "unnormalized") -> DataFrame:
    """Undo q01 / q99 scaling with the row's `action_stats`; dimensions whose mask is false stay as they are."""
    stats = F.col("action_stats")
    fields = [f.name for f in rows.schema["action_stats"].dataType.fields]
    mask = (lambda i: stats["mask"][i]) if "mask" in fields else (lambda i: F.lit(True))
    values = [A.unnormalize(F.col(vector)[i], stats["q01"][i], stats["q99"][i], mask(i)) for i in range(action_dim)]
    return rows.withColumn(out, F.array(*values))
