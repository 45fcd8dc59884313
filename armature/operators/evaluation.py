"""Metrics over predictions, training logs and rollouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.operators.episodes import with_neighbours, with_rolling_means
from armature.operators.ordering import with_running_totals


def token_pairs(rows: DataFrame, keys: Sequence[str], predicted: str, labels: str, vocab: int = A.VOCAB_SIZE) -> DataFrame:
    """(keys, pred, gt): the prediction made at a position beside the label one position later, action tokens only."""
    n = F.size(labels)
    pairs = F.arrays_zip(F.slice(predicted, 1, n - 1).alias("pred"), F.slice(labels, 2, n - 1).alias("gt"))
    flat = rows.select(*keys, F.inline(pairs).alias("pred", "gt"))
    return flat.filter(A.is_action_token(F.col("gt"), vocab))


def token_metrics(pairs: DataFrame, by: Sequence[str], vocab: int = A.VOCAB_SIZE) -> DataFrame:
    """Share of exact tokens and mean absolute difference of the decoded actions."""
    distance = F.abs(A.action_of_token(F.col("pred"), vocab) - A.action_of_token(F.col("gt"), vocab))
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.avg((F.col("pred") == F.col("gt")).cast("double")).alias("action_accuracy"),
        F.avg(distance).alias("l1_loss"),
    )


def dataset_metrics(pairs: DataFrame, vocab: int = A.VOCAB_SIZE) -> DataFrame:
    """Per dataset, the metrics of the last step whose batch mixes several datasets."""
    per_step = token_metrics(pairs, ["step", "dataset_name"], vocab)
    mixed = per_step.withColumn("__k", F.count(F.lit(1)).over(Window.partitionBy("step"))).filter("__k > 1")
    last = F.max_by(F.struct("step", "n_tokens", "action_accuracy", "l1_loss"), "step").alias("m")
    return mixed.groupBy("dataset_name").agg(last).select("dataset_name", "m.*")


def rolling_metrics(log: DataFrame, window: int, accumulation: int, run: str = "run_id") -> DataFrame:
    """Smoothed loss, l1 and accuracy, loss over the last accumulation steps, mean step time over the window.

    `log` is ordered by `timestep` inside each run.
    """
    timed = with_neighbours(log, {"__before": ("ts", -1)}, [run])
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    timed = timed.withColumn("step_time", (micros("ts") - micros("__before")) / 1e6).drop("__before")
    return with_rolling_means(
        timed,
        {
            "loss_smooth": ("loss", window),
            "l1_smooth": ("l1_loss", window),
            "accuracy_smooth": ("action_accuracy", window),
            "loss_raw": ("loss", accumulation),
            "mean_step_time": ("step_time", window),
        },
        [run],
    )


def thin_log(
    log: DataFrame, accumulation: int, every: int, save_every: int, dataset_length: int, global_batch: int, values: Sequence[str],
    run: str = "run_id",
) -> DataFrame:
    """One record per `every`-th gradient step: the last micro-batch's values, the epoch, and whether to save."""
    step = F.floor(F.col("timestep") / accumulation).cast("long")
    thinned = log.withColumn("grad_step", step).filter(F.col("grad_step") % every == 0)
    last = thinned.groupBy(run, "grad_step").agg(F.max_by(F.struct(*values), "timestep").alias("v"))
    per_epoch = dataset_length // global_batch
    return last.select(
        run, "grad_step",
        F.floor((F.col("grad_step") + 1) / per_epoch).cast("long").alias("epoch"),
        ((F.col("grad_step") > 0) & (F.col("grad_step") % save_every == 0)).alias("saves"),
        "v.*",
    )


def metric_records(rows: DataFrame, keys: Sequence[str], names: Mapping[str, Column]) -> DataFrame:
    """Long form of a metrics record: (keys, name, value), ready for a JSON log or a pivot."""
    cells = [F.struct(F.lit(n).alias("name"), c.cast("double").alias("value")) for n, c in names.items()]
    return rows.select(*keys, F.inline(F.array(*cells)))


def success_rates(rollouts: DataFrame) -> DataFrame:
    """Per task and, in the row without task, over all."""
    return rollouts.rollup("task").agg(
        F.count(F.lit(1)).alias("n_episodes"),
        F.count_if("success").alias("n_successes"),
        F.avg(F.col("success").cast("double")).alias("success_rate"),
    )


def running_success(rollouts: DataFrame, order: str = "run_order") -> DataFrame:
    """Counters after every finished rollout, in run order."""
    counted = with_running_totals(
        rollouts, [], [order], None,
        {"episodes_so_far": F.lit(1), "successes_so_far": F.col("success").cast("int")},
    )
    return counted.withColumn("success_percent", F.col("successes_so_far") / F.col("episodes_so_far") * 100)


# Step limit per task suite, and the steps waited before each episode.
STEP_LIMITS = {"libero_spatial": 220, "libero_object": 280, "libero_goal": 300, "libero_10": 520, "libero_90": 400}
WAIT_STEPS = 10


def step_limit(suite: Column) -> Column:
    limit = F.lit(None).cast("int")
    for name, steps in STEP_LIMITS.items():
        limit = F.when(suite == name, steps + WAIT_STEPS).otherwise(limit)
    return limit


def outcome(success: Column, steps: Column, limit: Column) -> Column:
    """An episode ends by success, by reaching its limit, or because something failed on the way."""
    return F.when(success, "success").when(steps >= limit, "timeout").otherwise("aborted")


def replay_report(marked: DataFrame, episode: Sequence[str], success: Column) -> DataFrame:
    """One row: replays, successes, their percentage, dropped no-ops. `success` is an aggregate over an episode."""
    per_episode = marked.groupBy(*episode).agg(success.alias("__ok"), F.count_if("is_noop").alias("__noops"))
    return per_episode.agg(
        F.count(F.lit(1)).alias("n_replays"),
        F.count_if("__ok").alias("n_successes"),
        (F.count_if("__ok") / F.count(F.lit(1)) * 100).alias("success_percent"),
        F.sum("__noops").alias("n_noops"),
    )


def throughput(log: DataFrame, tokens: Column, run: str = "run_id") -> DataFrame:
    """Tokens per second of each run, between its first and last record."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return log.groupBy(run).agg(F.sum(tokens).alias("n_tokens"), ((F.max(us) - F.min(us)) / 1e6).alias("seconds")).withColumn(
        "tokens_per_second", F.col("n_tokens") / F.col("seconds")
    )
