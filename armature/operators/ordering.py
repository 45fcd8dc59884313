"""Positions in an order, without ever sorting one group in one task.

`row_number()` over a whole table, or over a key that holds a third of it, is a single-task sort. Every position here is
computed in two steps instead: rows are cut into blocks by a coarse, order-preserving function of the sort key, block
sizes are summed by a map-side-combined aggregate, and a row's position is the size of all earlier blocks plus its
number inside its own block. Only the narrow (group, block, size) table is ever ordered as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armature.functions.chance import uniform
from armature.operators.smallside import cut_lineage

#: Blocks of a random order. Uniform numbers fill them evenly, so a block holds 1/65536 of its group.
RANDOM_BLOCKS = 1 << 16
#: Rows per block when the sort key is a dense counter.
COUNTER_BLOCK = 1 << 16


def random_block(u: Column, blocks: int = RANDOM_BLOCKS) -> Column:
    return F.floor(u * blocks).cast("long")


def counter_block(key: Column, rows: int = COUNTER_BLOCK) -> Column:
    return F.floor(key / rows).cast("long")


def by_ranges(df: DataFrame, columns: Sequence[str], blocks: int | None = None) -> DataFrame:
    """`df` in blocks of about equal size along `columns`, whatever their distribution: adds `__block`.

    Rows are dealt by ranges that Spark samples from the data, and written to the checkpoint folder, so that a block means the
    same rows to everyone who reads it. Without a number there are at most as many blocks as shuffle partitions; adaptive
    execution puts small neighbours together.
    """
    number = [] if blocks is None else [blocks]
    return cut_lineage(df.repartitionByRange(*number, *columns).withColumn("__block", F.spark_partition_id().cast("long")))


def time_block(ts: Column, seconds: int = 3600) -> Column:
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds).cast("long")


def _before(sizes: DataFrame, group: Sequence[str], totals: dict[str, str]) -> DataFrame:
    w = Window.partitionBy(*group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *group, "__block", *[F.coalesce(F.sum(src).over(w), F.lit(0)).alias(dst) for src, dst in totals.items()]
    )


def with_position(
    df: DataFrame, group: Sequence[str], order: Sequence[str], block: Column | None = None, name: str = "position"
) -> DataFrame:
    """Add the 0-based position of each row inside its group.

    `block` must not decrease along `order`; without it, blocks are sampled ranges. An empty `group` numbers the whole table.
    """
    group = list(group)
    blocked = by_ranges(df, [*group, *order]) if block is None else df.withColumn("__block", block)
    sizes = blocked.groupBy(*group, "__block").agg(F.count(F.lit(1)).alias("__size"))
    offsets = _before(sizes, group, {"__size": "__offset"})
    inside = Window.partitionBy(*group, "__block").orderBy(*order)
    numbered = blocked.withColumn("__row", F.row_number().over(inside).cast("long") - 1)
    return (
        numbered.join(offsets, [*group, "__block"])
        .withColumn(name, F.col("__row") + F.col("__offset"))
        .drop("__block", "__row", "__offset")
    )


def with_random_position(
    df: DataFrame,
    group: Sequence[str],
    key: Sequence[str],
    seed: int,
    name: str = "position",
    draw_keys: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Position in a full, replayable shuffle of each group; ties of the draw are broken by `key`."""
    drawn = df.withColumn("__u", uniform(seed, *(draw_keys or key)))
    return with_position(drawn, group, ["__u", *key], random_block(F.col("__u")), name).drop("__u")


def with_running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[str], block: Column | None, totals: dict[str, Column]
) -> DataFrame:
    """Add inclusive running sums of row-level expressions along an order, block by block; see `with_position`."""
    group = list(group)
    blocked = by_ranges(df, [*group, *order]) if block is None else df.withColumn("__block", block)
    sizes = blocked.groupBy(*group, "__block").agg(*[F.sum(c).alias(f"__sum_{n}") for n, c in totals.items()])
    offsets = _before(sizes, group, {f"__sum_{n}": f"__before_{n}" for n in totals})
    inside = Window.partitionBy(*group, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = blocked.select("*", *[F.sum(c).over(inside).alias(f"__run_{n}") for n, c in totals.items()])
    joined = running.join(offsets, [*group, "__block"])
    for n in totals:
        joined = joined.withColumn(n, F.col(f"__run_{n}") + F.col(f"__before_{n}")).drop(f"__run_{n}", f"__before_{n}")
    return joined.drop("__block")
