"""Batch plans: modality-pure batches, length buckets, replica slices, distributed sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armature.operators.ordering import with_position, with_random_position
from armature.operators.smallside import cut_lineage, pin_small

#: Image patches an image adds to an example when batches are compared by length.
PATCHES = 576


def in_batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """Consecutive groups of `size` rows of an order; the last one may be short. Adds batch_no, slot."""
    placed = with_position(df, [], [order], name="__at")
    return placed.withColumns(
        {"batch_no": F.floor(F.col("__at") / size).cast("long"), "slot": (F.col("__at") % size).cast("int")}
    ).drop("__at")


def epoch_seed(seed: int, epoch: int) -> int:
    if not 0 < seed < 2**32 - 1:
        raise ValueError("seed must fit an unsigned 32-bit integer")
    return seed + epoch


def _wrapped(placed: DataFrame, position: str, total: Column, step: int) -> DataFrame:
    """Go round the rows again after the last, as often as it takes, so that their number is a multiple of `step`."""
    last = total + F.pmod(-total, F.lit(step)) - 1
    at = F.col(position).cast("long")
    return placed.withColumn(position, F.explode(F.sequence(at, last.cast("long"), total.cast("long"))))


def modality_batches(examples: DataFrame, size: int, seed: int) -> DataFrame:
    """Shuffle each modality, cut it into batches, fill the last one from the first, sort batches by length.

    Adds batch_no (within the modality) and slot. A few examples appear twice when a modality is no multiple of `size`. It is
    an error if there is no image example, or if a modality is less than half a batch, which going round once cannot fill.
    """
    placed = with_random_position(
        examples, ["is_multimodal"], ["example_id"], seed, "__at", ["is_multimodal", "example_id"]
    )
    counts = examples.groupBy("is_multimodal").agg(F.count(F.lit(1)).alias("__n"))
    known = {r["is_multimodal"]: r["__n"] for r in counts.collect()}  # two rows at most
    if known and not known.get(True):
        raise ValueError("no image examples")
    if any(2 * n < size for n in known.values()):
        raise ValueError(f"a modality has less than half a batch of {size} examples")
    totals = pin_small(counts)
    full = _wrapped(placed.join(totals, "is_multimodal"), "__at", F.col("__n"), size)
    batched = full.withColumn("batch_no", F.floor(F.col("__at") / size).cast("long"))
    w = Window.partitionBy("is_multimodal", "batch_no").orderBy(F.col("n_words").desc(), "__at")
    return batched.withColumn("slot", (F.row_number().over(w) - 1).cast("int")).drop("__at", "__n")


def length_buckets(batches: DataFrame, replicas: int) -> DataFrame:
    """Deal each sorted batch to `replicas` equal buckets: every example goes to the lightest bucket that has room, the first
    of equals. Replaces `slot` by bucket order.

    A walk over the rows of a batch, which is a bounded group; batches are dealt in parallel.
    """
    columns = [c for c in batches.columns if c not in ("is_multimodal", "batch_no", "slot")]
    row = F.struct("slot", *columns)
    kind = batches.select(row.alias("r")).schema["r"].dataType.simpleString()
    rows = batches.groupBy("is_multimodal", "batch_no").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    room = (F.size("rows") / replicas).cast("int")
    even = F.when(F.size("rows") % replicas == 0, F.col("rows")).otherwise(F.raise_error(F.lit("batch size is no multiple of the number of replicas")))
    start = F.struct(
        F.array_repeat(F.lit(0.0), replicas).alias("weight"),
        F.array_repeat(F.lit(0), replicas).alias("count"),
        F.array().cast(f"array<struct<r:{kind},bucket:int,slot:int>>").alias("out"),
    )

    def deal(state: Column, r: Column) -> Column:
        bucket = F.array_position(state["weight"], F.array_min(state["weight"])).cast("int") - 1
        held = state["count"][bucket]
        filled = F.when(held + 1 == room, F.lit(float("inf"))).otherwise(state["weight"][bucket] + r["n_words"])
        placed = F.struct(r.alias("r"), bucket.alias("bucket"), (bucket * room + held).alias("slot"))
        return F.struct(
            F.transform(state["weight"], lambda x, i: F.when(i == bucket, filled).otherwise(x)).alias("weight"),
            F.transform(state["count"], lambda x, i: F.when(i == bucket, x + 1).otherwise(x)).alias("count"),
            F.array_append(state["out"], placed).alias("out"),
        )

    dealt = rows.withColumn("rows", even).select("is_multimodal", "batch_no", F.explode(F.aggregate("rows", start, deal, lambda s: s["out"])).alias("d"))
    return dealt.select("is_multimodal", "batch_no", "d.slot", "d.bucket", *[f"d.r.{c}" for c in columns])


def batch_order(batches: DataFrame, seed: int) -> DataFrame:
    """One row per batch with its place in the epoch: random, except that the batch holding the longest example (image
    patches included) swaps places with the first. Of equal lengths the earlier batch wins."""
    weight = F.col("n_words") + F.when(F.col("is_multimodal"), PATCHES).otherwise(0)
    # one narrow row per batch, read several times below
    table = cut_lineage(batches.groupBy("is_multimodal", "batch_no").agg(F.max(weight).alias("longest")))
    placed = with_random_position(table, [], ["is_multimodal", "batch_no"], seed, "__at", [F.lit("batch"), "is_multimodal", "batch_no"])
    first = F.lit(placed.agg(F.max_by("__at", F.struct("longest", -F.col("__at")))).first()[0])
    at = F.col("__at")
    order = F.when(at == first, F.lit(0)).when(at == 0, first).otherwise(at).cast("long")
    return placed.withColumn("epoch_batch", order).drop("__at")


def replica_slices(batches: DataFrame, order: DataFrame, size: int, replicas: int) -> DataFrame:
    """Cut the epoch into slices of size / replicas; slice j belongs to rank j mod replicas."""
    joined = batches.join(order.select("is_multimodal", "batch_no", "epoch_batch"), ["is_multimodal", "batch_no"])
    index = F.col("epoch_batch") * size + F.col("slot")
    piece = F.floor(index / (size // replicas))
    return joined.withColumns({"index": index, "rank": (piece % replicas).cast("int")})


def cover_report(batches: DataFrame, examples: DataFrame, size: int, replicas: int) -> DataFrame:
    """One row: examples, planned rows, examples that no batch holds, divisibility, presence of image examples."""
    plan = batches.groupBy("example_id").agg(F.count(F.lit(1)).alias("__times"))
    both = examples.select("example_id", "is_multimodal").join(plan, "example_id", "left")
    return both.agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.sum(F.coalesce("__times", F.lit(0))).alias("n_rows"),
        F.count_if(F.col("__times").isNull()).alias("n_missing"),
        F.count_if("is_multimodal").alias("n_multimodal"),
    ).select(
        "*",
        (F.col("n_rows") % size == 0).alias("divides_batches"),
        (F.col("n_rows") % replicas == 0).alias("divides_replicas"),
        ((F.col("n_missing") == 0) & (F.col("n_multimodal") > 0)).alias("complete"),
    )


def distributed_sample(examples: DataFrame, replicas: int, seed: int) -> DataFrame:
    """Shuffled order, wrapped to a multiple of `replicas`; rank r takes every replicas-th row."""
    placed = with_random_position(examples, [], ["example_id"], seed, "__at")
    total = F.lit(examples.count())
    full = _wrapped(placed, "__at", total, replicas)
    return full.withColumns(
        {"rank": (F.col("__at") % replicas).cast("int"), "index": F.floor(F.col("__at") / replicas).cast("long")}
    ).drop("__at")
