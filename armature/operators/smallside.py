"""Small sides of joins: broadcast only what was counted, and keep another way for what turns out large."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One row per dataset (statistics, weights, sizes): what is broadcast is at most so many rows and bytes.
MAX_SMALL_ROWS = 10_000
MAX_SMALL_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: the cluster's `spark.checkpoint.dir`, else (tests) a local one."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = known.get() if known.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="armature-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut_lineage(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint()


def pin_small(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> DataFrame:
    """Compute a per-dataset table once.

    It is written to the checkpoint folder and measured there. If it has at most `max_rows` rows and MAX_SMALL_BYTES bytes, as
    JSON, it is marked for broadcast; a larger one is joined by shuffle, where adaptive execution splits skewed keys.
    """
    kept = cut_lineage(df)
    size = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, wide = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(kept) if rows <= max_rows and wide <= MAX_SMALL_BYTES else kept
