"""Per-dataset, per-dimension statistics and the normalizations built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armature.functions import vectors as V
from armature.operators.smallside import pin_small

PROBABILITIES = (0.01, 0.99)
#: Rank error of the bracketing sketch is at most rows / SKETCH_ACCURACY.
SKETCH_ACCURACY = 5_000
#: The same for quantiles that stay approximate.
APPROXIMATE_ACCURACY = 10_000


def bracket_aggregates(value: str, probabilities: Sequence[float], accuracy: int) -> list[Column]:
    """Aggregates of the first pass: group size, extremes and a sketch that encloses each wanted quantile."""
    margin = 2.0 / accuracy
    around = [q for p in probabilities for q in (max(0.0, p - margin), min(1.0, p + margin))]
    return [
        F.count(value).alias("__n"),
        F.min(value).alias("__min"),
        F.max(value).alias("__max"),
        F.percentile_approx(value, around, accuracy).alias("__b"),
    ]


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float] = PROBABILITIES,
    accuracy: int = SKETCH_ACCURACY,
    first_pass: DataFrame | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per (group, probability): columns `p`, `quantile`.

    `percentile()` keeps a map of every distinct value of a group in one task. Here a mergeable sketch first gives two
    values that are sure to enclose the wanted ranks; a second pass counts what lies below and keeps, as (value, count),
    only what lies between: about 4 * rows / accuracy values per group, however large the group is.
    """
    group = list(group)
    if first_pass is None:
        first_pass = pin_small(df.groupBy(*group).agg(*bracket_aggregates(value, probabilities, accuracy)))
    # on tiny groups one rank is more than the margin: enclose everything
    tiny = F.col("__n") < 4 * accuracy
    bounds = first_pass.select(
        *group, "__n",
        *[F.when(tiny, F.col("__min")).otherwise(F.col("__b")[2 * i]).alias(f"__lo{i}") for i in range(len(probabilities))],
        *[F.when(tiny, F.col("__max")).otherwise(F.col("__b")[2 * i + 1]).alias(f"__hi{i}") for i in range(len(probabilities))],
    )
    v = F.col(value)
    ranges = [(F.col(f"__lo{i}"), F.col(f"__hi{i}")) for i in range(len(probabilities))]
    inside = F.lit(False)
    for low, high in ranges:
        inside = inside | ((v >= low) & (v <= high))
    # values outside all ranges are only counted, at the upper end of the last range below them
    passed = [F.when(v > high, high) for _, high in ranges]
    floor_of = F.greatest(*passed) if len(passed) > 1 else passed[0]
    folded = df.join(bounds, group).filter(v.isNotNull()).select(
        *group, "__n", F.when(inside, v).otherwise(floor_of).cast("double").alias("__v"), (~inside).alias("__outside")
    )
    counted = folded.groupBy(*group, "__n", "__v", "__outside").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*group).orderBy(F.col("__v").asc_nulls_first(), "__outside")
    upto = counted.withColumn("__upto", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("__upto") > rank) & (F.col("__upto") - F.col("__c") <= rank), F.col("__v")))

    ends, found = [], []
    for i, p in enumerate(probabilities):
        rank = (F.col("__n") - 1) * F.lit(float(p))
        low = F.floor(rank)
        ends += [at_rank(low).alias(f"__a{i}"), at_rank(F.least(low + 1, F.col("__n") - 1)).alias(f"__z{i}")]
        between = F.col(f"__a{i}") + (F.col(f"__z{i}") - F.col(f"__a{i}")) * (rank - low)
        found.append(F.struct(F.lit(float(p)).alias("p"), between.alias("quantile")))
    return upto.groupBy(*group, "__n").agg(*ends).select(*group, F.inline(F.array(*found)))


def long_values(steps: DataFrame, keys: Sequence[str] = ("action", "proprio")) -> DataFrame:
    """(dataset_name, key, dim, value): one row per vector element, made inside the scan stage."""
    pieces = F.array(*[F.struct(F.lit(k).alias("key"), V.doubles(k).alias("vector")) for k in keys])
    return (
        steps.select("dataset_name", F.explode(pieces).alias("__kv"))
        .select("dataset_name", "__kv.key", F.posexplode("__kv.vector").alias("dim", "value"))
    )


def with_proprio(steps: DataFrame) -> DataFrame:
    """A dataset without proprio counts as zeros shaped like its action."""
    if "proprio" in steps.columns:
        return steps
    return steps.withColumn("proprio", F.transform("action", lambda _: F.lit(0.0)))


def dimension_statistics(
    steps: DataFrame, approximate: bool = False, quantiles: bool = True, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Long form: dataset_name, key, dim, mean, std, min, max, q01, q99. Without `quantiles` the last two are null, and one
    pass does; exact ones take a second pass over the values that the sketch of the first encloses."""
    values = long_values(with_proprio(steps))
    group = ["dataset_name", "key", "dim"]
    moments = [
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    if approximate:
        sketch = F.percentile_approx("value", list(PROBABILITIES), APPROXIMATE_ACCURACY)
        return values.groupBy(*group).agg(*moments, sketch[0].alias("q01"), sketch[1].alias("q99"))
    if not quantiles:
        none = F.lit(None).cast("double")
        return values.groupBy(*group).agg(*moments).select(*group, "mean", "std", "min", "max", none.alias("q01"), none.alias("q99"))
    # pass 1: moments and sketch together, one row per (dataset, key, dim); pass 2: the ranks the sketch enclosed
    first = pin_small(values.groupBy(*group).agg(*moments, *bracket_aggregates("value", PROBABILITIES, accuracy)))
    quantiles = exact_quantiles(values, group, "value", accuracy=accuracy, first_pass=first)
    wide = quantiles.groupBy(*group).agg(
        F.max(F.when(F.col("p") == 0.01, F.col("quantile"))).alias("q01"),
        F.max(F.when(F.col("p") == 0.99, F.col("quantile"))).alias("q99"),
    )
    return first.select(*group, "mean", "std", "min", "max").join(wide, group)


def quantile_ranks(values: DataFrame, stats: DataFrame, accuracy: int = APPROXIMATE_ACCURACY) -> DataFrame:
    """`stats` with `q01_in_bounds` and `q99_in_bounds`: whether the rank of the quantile, a range where values repeat, comes
    within rows / accuracy of the wanted one. One pass over `values` with a counted small side."""
    group = ["dataset_name", "key", "dim"]
    small = pin_small(stats)
    below = [F.count_if(F.col("value") < F.col(q)).alias(f"__below_{q}") for q in ("q01", "q99")]
    upto = [F.count_if(F.col("value") <= F.col(q)).alias(f"__upto_{q}") for q in ("q01", "q99")]
    counted = values.join(small.select(*group, "q01", "q99"), group).groupBy(*group).agg(F.count("value").alias("__n"), *below, *upto)
    n, slack = F.col("__n"), F.col("__n") / accuracy + 1
    fits = [((F.col(f"__below_{q}") <= n * w + slack) & (F.col(f"__upto_{q}") >= n * w - slack)).alias(f"{q}_in_bounds") for q, w in zip(("q01", "q99"), PROBABILITIES)]
    return counted.select(*group, *fits).join(small, group)


def dataset_sizes(steps: DataFrame) -> DataFrame:
    """Transitions and episodes per dataset, validation and unlabeled episodes included."""
    return steps.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("num_transitions"), F.countDistinct("episode_id").alias("num_trajectories")
    )


STATISTICS = ("mean", "std", "min", "max", "q01", "q99")


def vectors_of(long_stats: DataFrame) -> DataFrame:
    """One row per (dataset, key) with one array per statistic, ordered by dimension."""
    ordered = F.sort_array(F.collect_list(F.struct("dim", *STATISTICS)))
    nested = long_stats.groupBy("dataset_name", "key").agg(ordered.alias("__s"))
    return nested.select("dataset_name", "key", *[F.col(f"__s.{s}").alias(s) for s in STATISTICS])


def dataset_statistics(steps: DataFrame, approximate: bool = False, quantiles: bool = True) -> DataFrame:
    """One row per dataset: struct columns `action` and `proprio` of arrays, plus the two sizes."""
    arrays = vectors_of(dimension_statistics(steps, approximate, quantiles))
    one = F.struct(*STATISTICS)
    wide = arrays.groupBy("dataset_name").agg(
        F.max(F.when(F.col("key") == "action", one)).alias("action"),
        F.max(F.when(F.col("key") == "proprio", one)).alias("proprio"),
    )
    return wide.join(dataset_sizes(steps), "dataset_name")


def normalize_element(x: Column, i: int, stats: Column, how: str, mask: Column | None) -> Column:
    """One element under "normal", "bounds" or "bounds_q99"; `mask` false leaves it alone."""
    s = {name: stats[name][i] for name in STATISTICS}
    if how == "normal":
        scaled = (x - s["mean"]) / (s["std"] + 1e-8)
        return scaled if mask is None else F.when(mask, scaled).otherwise(x)
    low, high = (s["min"], s["max"]) if how == "bounds" else (s["q01"], s["q99"])
    scaled = V.clip(2.0 * (x - low) / (high - low + 1e-8) - 1.0, -1.0, 1.0)
    kept = scaled if mask is None else F.when(mask, scaled).otherwise(x)
    return F.when(s["min"] == s["max"], 0.0).otherwise(kept)  # unused dimensions become 0 even when masked out


def normalize(
    steps: DataFrame,
    stats: DataFrame,
    how: str,
    action_dim: int,
    proprio_dim: int = 0,
    action_mask: Sequence[bool] | None = None,
) -> DataFrame:
    """Normalize `action` (and `proprio`) with the row's dataset statistics.

    `stats` is a `dataset_statistics` table, best passed through `pin_small`.
    """
    if how not in ("normal", "bounds", "bounds_q99"):
        raise ValueError(f"unknown normalization {how}")
    if action_mask is not None and len(action_mask) != action_dim:
        raise ValueError(f"mask of length {len(action_mask)} for {action_dim} action dimensions")
    side = stats.select("dataset_name", F.col("action").alias("__a"), F.col("proprio").alias("__p"))
    joined = steps.join(side, "dataset_name")
    mask = (lambda i: None) if action_mask is None else (lambda i: F.lit(bool(action_mask[i])))
    out = joined.withColumn(
        "action", V.each("action", action_dim, lambda x, i: normalize_element(x, i, F.col("__a"), how, mask(i)))
    )
    if proprio_dim:
        out = out.withColumn(
            "proprio", V.each("proprio", proprio_dim, lambda x, i: normalize_element(x, i, F.col("__p"), how, None))
        )
    return out.drop("__a", "__p")
