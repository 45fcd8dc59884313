"""Weighted dataset mixtures: selection, weights, reproducible epochs, quotas."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from armature.functions.chance import uniform
from armature.operators.ordering import COUNTER_BLOCK, RANDOM_BLOCKS, with_position, with_random_position
from armature.operators.smallside import cut_lineage, pin_small
from armature.operators.statistics import dataset_sizes


def split_by_episode(
    steps: DataFrame, train_percent: int = 95, keys: Sequence[str] = ("dataset_name", "episode_id"), stored: str | None = None
) -> DataFrame:
    """Train / val by whole episodes in stored (id) order: the first `train_percent` % of a dataset train.

    `stored` names a column with the split an episode came with. A dataset that has a "val" split keeps its splits as they
    are; the others are cut.
    """
    dataset, episode = keys
    if stored is not None:
        has_val = pin_small(steps.groupBy(dataset).agg(F.max(F.coalesce(F.col(stored) == "val", F.lit(False))).alias("__has_val")))
        marked = steps.join(has_val, dataset)
        own = marked.filter("__has_val").withColumn("split", F.coalesce(stored, F.lit("train"))).drop("__has_val")
        cut = split_by_episode(marked.filter("NOT __has_val").drop("__has_val"), train_percent, keys)
        return own.unionByName(cut)
    found = steps.select(*keys).distinct()
    numbered = with_position(found, [dataset], [episode], name="__idx")
    counts = pin_small(found.groupBy(dataset).agg(F.count(F.lit(1)).alias("__n")))
    cut = F.floor(F.col("__n") * train_percent / F.lit(100.0) + 0.5)
    sides = numbered.join(counts, dataset).select(*keys, F.when(F.col("__idx") < cut, "train").otherwise("val").alias("split"))
    return steps.join(sides, list(keys))


def select_mixture(mixture: DataFrame, available: DataFrame, group: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped) entries. The first entry of a dataset wins; unavailable datasets go with their weight.

    `group` names the columns that tell several mixtures apart.
    """
    first = Window.partitionBy(*group, "dataset_name").orderBy("pos")
    unique = mixture.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
    kept = unique.join(available, "dataset_name", "left_semi")
    return kept, unique.join(available, "dataset_name", "left_anti")


def mixture_weights(mixture: DataFrame, sizes: DataFrame, balance: bool = True) -> DataFrame:
    """pos, dataset_name, weight (raw), num_transitions, sample_weight (sums to 1), primary (raw weight exactly 1)."""
    scaled = F.col("weight") * F.col("num_transitions") if balance else F.col("weight")
    joined = mixture.join(sizes.select("dataset_name", "num_transitions"), "dataset_name").withColumn("__w", scaled)
    total = Window.partitionBy()  # the mixture is a list of at most a few hundred names
    return joined.select(
        "pos", "dataset_name", "weight", "num_transitions",
        (F.col("__w") / F.sum("__w").over(total)).alias("sample_weight"),
        (F.col("weight") == 1.0).alias("primary"),
    )


def effective_length(weights: DataFrame) -> DataFrame:
    """Samples until every primary dataset has been seen once; a mixture without primary dataset is an error."""
    longest = F.max(F.when(F.col("primary"), F.col("num_transitions") / F.col("sample_weight")))
    missing = F.raise_error(F.lit("mixture has no dataset of weight 1.0"))
    return weights.agg(longest.alias("l")).select(
        F.when(F.col("l").isNotNull(), F.floor("l").cast("long")).otherwise(missing).alias("dataset_length")
    )


def _cumulative(weights: DataFrame) -> list[tuple[str, float, int]]:
    """(dataset, upper bound, size) per entry, on the driver: a mixture is a short list."""
    rows = weights.select("pos", "dataset_name", "sample_weight", "num_transitions").orderBy("pos").collect()
    bounds, total = [], 0.0
    for row in rows:
        total += row["sample_weight"]
        bounds.append((row["dataset_name"], total, row["num_transitions"]))
    return bounds


def sizes_by_name(frames: DataFrame) -> dict[str, int]:
    """Frames per dataset, one number for each name of the mixture."""
    return {r["dataset_name"]: r["n"] for r in frames.groupBy("dataset_name").agg(F.count(F.lit(1)).alias("n")).collect()}


def pick_datasets(positions: DataFrame, weights: DataFrame, seed: int, sizes: dict[str, int] | None = None) -> DataFrame:
    """Give every position a dataset: the interval of the cumulative weights that its uniform number falls into.

    A handful of literal bounds in one CASE: no join. `sizes` replaces the datasets' transition counts where frames were
    filtered out; a dataset without any is not drawn, and the others share its draws by weight.
    """
    bounds = _cumulative(weights)
    if sizes is not None:
        left, kept, total, below = [], 0.0, bounds[-1][1], 0.0
        for name, upper, _ in bounds:
            share, below = upper - below, upper
            if sizes.get(name, 0):
                kept += share
                left.append((name, kept, sizes[name]))
        if not left:
            raise ValueError("no dataset of the mixture has frames")
        bounds = left if len(left) == len(bounds) else [(name, upper / kept * total, n) for name, upper, n in left]
    u = F.col("__u")
    name, size = F.lit(bounds[-1][0]), F.lit(bounds[-1][2])
    for dataset, upper, n in reversed(bounds[:-1]):
        name, size = F.when(u < upper, dataset).otherwise(name), F.when(u < upper, n).otherwise(size)
    drawn = positions.withColumn("__u", uniform(seed, "p"))
    return drawn.select("p", name.alias("dataset_name"), size.cast("long").alias("__size"))


def epoch_orders(frames: DataFrame, key: Sequence[str], epochs: DataFrame, seed: int) -> DataFrame:
    """Every dataset's frames in a fresh random order per epoch: adds `epoch` and `idx`.

    `epochs` holds dataset_name, n_epochs; the result has exactly as many rows as those epochs have frames.
    """
    repeated = frames.join(pin_small(epochs), "dataset_name").select(
        *frames.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_epochs") - 1)).alias("epoch")
    )
    return with_random_position(
        repeated, ["dataset_name", "epoch"], list(key), seed, "idx", ["dataset_name", "epoch", *key]
    )


def sample_frames(
    frames: DataFrame, key: Sequence[str], weights: DataFrame, n: int, seed: int, sizes: dict[str, int] | None = None
) -> DataFrame:
    """An epoch of `n` frames: position p, its dataset, which pick of that dataset it is, and the frame.

    Pick k of a dataset is frame `k mod size` of that dataset's order in epoch `k div size`.
    """
    spark = frames.sparkSession
    positions = spark.range(n).withColumnRenamed("id", "p")
    picks = pick_datasets(positions, weights, seed, sizes)
    per_block = max(COUNTER_BLOCK, -(-n // RANDOM_BLOCKS))  # never more blocks than a random order has
    numbered = with_position(picks, ["dataset_name"], ["p"], F.floor(F.col("p") / per_block).cast("long"), "k")
    located = numbered.withColumns(
        {"epoch": F.floor(F.col("k") / F.col("__size")).cast("long"), "idx": F.col("k") % F.col("__size")}
    ).drop("__size")
    epochs = picks.groupBy("dataset_name", "__size").agg(
        F.ceil(F.count(F.lit(1)) / F.col("__size")).cast("long").alias("n_epochs")
    ).drop("__size")
    return located.join(epoch_orders(frames, key, epochs, seed), ["dataset_name", "epoch", "idx"])


def least_draws(frames: DataFrame, key: Sequence[str], size: int, seed: int, bins: int = 1 << 16) -> DataFrame:
    """The `size` frames whose draw is least (then by `key`), without ordering more than a sliver of them.

    A histogram of the draws, at most `bins` counts, says below which draw everything is taken; the bin on the border is cut finer
    until it holds few frames, and only those are put in order. Frames of equal keys draw alike and cannot be told apart.
    """
    drawn = frames.withColumn("__u", uniform(seed, *key))
    low, high, left = 0.0, 1.0, size
    while True:
        width = (high - low) / bins
        slot = F.least(F.floor((F.col("__u") - low) / width).cast("long"), F.lit(bins - 1))
        counts = dict(drawn.filter((F.col("__u") >= low) & (F.col("__u") < high)).groupBy(slot.alias("slot")).count().collect())
        taken, border = 0, None
        for b in sorted(counts):
            if taken + counts[b] > left:
                border = b
                break
            taken += counts[b]
        left -= taken
        if border is None:  # there are no more frames than wanted
            return drawn.filter(F.col("__u") < high).drop("__u")
        low, high = low + border * width, low + (border + 1) * width
        if counts[border] <= bins or width <= 2.0**-52:
            break
    edge = drawn.filter((F.col("__u") >= low) & (F.col("__u") < high)).orderBy("__u", *key).limit(left)
    return drawn.filter(F.col("__u") < low).unionByName(edge).drop("__u")


def fixed_buffer(frames: DataFrame, key: Sequence[str], size: int, seed: int) -> DataFrame:
    """The first `size` frames of a shuffle, kept on shared storage so that every later pass sees the same ones."""
    return cut_lineage(least_draws(frames, key, size, seed))


def kept_version(spark: SparkSession, folder: str, version: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What was kept under `version` of `folder`; if nothing was yet, `build()` is written there first, once.

    Every later pass, in this session or another, reads the same rows. A write that failed leaves no version behind it.
    """
    path = f"{folder.rstrip('/')}/{version}"
    home = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(home):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def buffered_order(frames: DataFrame, stored: str, buffer: int, seed: int, key: Sequence[str]) -> DataFrame:
    """Shuffle only inside consecutive runs of `buffer` rows of the stored order: adds `buffer_no`, `position`."""
    numbered = with_position(frames, [], [stored], name="__at")
    runs = numbered.withColumns(
        {"buffer_no": F.floor(F.col("__at") / buffer).cast("long"), "__u": uniform(seed, *key)}
    )
    w = Window.partitionBy("buffer_no").orderBy("__u", *key)
    return runs.withColumn("position", F.col("buffer_no") * buffer + F.row_number().over(w) - 1).drop("__at", "__u")


def quota_table(entries: DataFrame, n: int) -> DataFrame:
    """`entries` (pos, weight, ...) with `quota`: whole numbers that sum to n, follow the weights and give every positive
    weight at least one.

    In the order of their weights, the first k positive entries have exactly one, where k is least such that every later
    entry's share of the other n - k rows, by weight among themselves, is one or more. Those get their share rounded down,
    and what is left goes to the largest remainders, of equal ones to the later position. The mixture is a list of names, so
    its windows are over a short table.
    """
    checks = entries.agg(F.count(F.lit(1)).alias("entries"), F.coalesce(F.min("weight"), F.lit(0.0)).alias("least")).first()
    if checks["least"] < 0:
        raise ValueError("weights must not be negative")
    if checks["entries"] > n:
        raise ValueError("fewer rows than entries")
    everything = Window.partitionBy()
    rising = Window.orderBy((F.col("weight") <= 0).cast("int"), "weight", "pos")
    ranked = entries.withColumns({
        "__rank": F.row_number().over(rising) - 1,
        "__rest": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
    })
    positive, room = F.col("weight") > 0, n - F.col("__rank")
    reaches_one = positive & (F.col("weight") * room >= F.col("__rest"))
    from_here = ranked.withColumn("__ones", F.coalesce(F.min(F.when(reaches_one, F.col("__rank"))).over(everything), F.count_if(positive).over(everything)))
    shared = positive & (F.col("__rank") >= F.col("__ones"))
    weights = F.sum(F.when(shared, F.col("weight"))).over(everything)
    parts = from_here.withColumn("__share", F.when(shared, F.col("weight") / weights * (n - F.col("__ones"))))
    floors = parts.withColumn("__floor", F.floor("__share"))
    spare = n - F.col("__ones") - F.coalesce(F.sum("__floor").over(everything), F.lit(0))
    place = F.row_number().over(Window.orderBy((F.col("__share") - F.col("__floor")).desc_nulls_last(), F.desc("pos")))
    quota = F.when(shared, F.col("__floor") + (place <= spare).cast("int")).when(positive, 1).otherwise(0)
    return floors.withColumn("quota", quota.cast("long")).select(*entries.columns, "quota")


def stratified_extract(frames: DataFrame, quotas: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    """Exactly `quota` random frames of each dataset of `quotas` (dataset_name, quota); all of them if it has fewer."""
    placed = with_random_position(frames, ["dataset_name"], list(key), seed, "__at")
    return placed.join(pin_small(quotas.select("dataset_name", "quota")), "dataset_name").filter(F.col("__at") < F.col("quota")).drop("__at")


def synthetic_frames(ids: DataFrame, seed: int, dims: int = 7) -> DataFrame:
    """Stand-in frames: uniform actions and one fixed instruction."""
    action = F.array(*[uniform(seed, "id", F.lit(i)) for i in range(dims)])
    return ids.select("id", action.alias("action"), F.lit("do something spectacular").alias("instruction"))


def sizes_of(frames: DataFrame) -> DataFrame:
    return pin_small(dataset_sizes(frames))
