"""Mixture, sampling and ordering jobs."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from armature.operators import batching as B
from armature.operators import mixtures as M
from armature.operators import statistics as T
from armature.operators import trajectories as J
from armature.operators.ordering import with_random_position
from armature.operators.smallside import cut_lineage, pin_small
from armature.plans import views as W
from armature.plans.jobs_sources import ACTIONS
from armature.plans.jobs_trajectories import GRIPPER_MASK, WIDE_STATS, normalized_sql
from armature.plans.registry import job, r6, sql_r6, sql_wide, wide
from armature.sources.sinks import scratch
from armature.sources.tables import table

KEYS = ["dataset_name", "episode_id", "timestep"]

SIZES = "SELECT dataset_name, count(*) AS n FROM v_steps GROUP BY 1"
WEIGHTS = """SELECT pos, dataset_name, weight, n, weight * n / sum(weight * n) OVER () AS sample_weight
  FROM (SELECT dataset_name, min(pos) AS pos, arg_min(weight, pos) AS weight FROM v_mixture GROUP BY 1) JOIN sizes USING (dataset_name)"""
CUMULATIVE = "SELECT *, sum(sample_weight) OVER (ORDER BY pos) AS hi, sum(sample_weight) OVER (ORDER BY pos) - sample_weight AS lo, max(pos) OVER () AS last_pos FROM w"


def weights_of(spark, d):
    sizes = M.sizes_of(W.step_rows(spark, d))
    kept, _ = M.select_mixture(W.mixture(spark), sizes)
    return pin_small(M.mixture_weights(kept, sizes))


@job(
    "mixture_weights",
    W.sql("v_steps v_mixture", f"SELECT CAST(pos AS INT) AS pos, dataset_name, weight, n AS num_transitions, {sql_r6('sample_weight', 'sample_weight')}, weight = 1.0 AS \"primary\" FROM w", sizes=SIZES, w=WEIGHTS),
)
def mixture_weights(spark, d):
    return weights_of(spark, d).withColumn("sample_weight", r6("sample_weight"))


@job(
    "effective_length",
    W.sql("v_steps v_mixture", "SELECT CAST(floor(max(n / sample_weight) FILTER (weight = 1.0)) AS BIGINT) AS dataset_length FROM w", sizes=SIZES, w=WEIGHTS),
)
def effective_length(spark, d):
    return M.effective_length(weights_of(spark, d))


def pick_ctes(frames: str, n: str, seed: int) -> dict[str, str]:
    """drawn_from: the interval of each dataset that has frames, which share the draws of those without; located: picks with epoch
    and idx; ranked: frames in their epoch orders."""
    return {
        "sizes": SIZES,
        "w": WEIGHTS,
        "cum": CUMULATIVE,
        "frame_sizes": f"SELECT dataset_name, count(*) AS size FROM {frames} GROUP BY 1",
        "positions": f"SELECT p, {W.draw(seed, 'p')} AS u FROM (SELECT unnest(range(0, ({n}))) AS p)",
        "drawn_from": """SELECT dataset_name, size, pos = max(pos) OVER () AS is_last,
            CASE WHEN n_left = n_all THEN lo ELSE coalesce(lag(upto) OVER (ORDER BY pos), 0) / kept * total END AS lo, CASE WHEN n_left = n_all THEN hi ELSE upto / kept * total END AS hi
          FROM (SELECT c.dataset_name, pos, lo, hi, size, sum(hi - lo) OVER (ORDER BY pos) AS upto, sum(hi - lo) OVER () AS kept, count(*) OVER () AS n_left,
                  (SELECT count(*) FROM cum) AS n_all, (SELECT max(hi) FROM cum) AS total FROM cum c JOIN frame_sizes f ON f.dataset_name = c.dataset_name)""",
        "located": """SELECT p, dataset_name, k, k // size AS epoch, k % size AS idx FROM
          (SELECT p, c.dataset_name, size, row_number() OVER (PARTITION BY c.dataset_name ORDER BY p) - 1 AS k
           FROM positions JOIN drawn_from c ON u >= lo AND (u < hi OR is_last))""",
        "ranked": f"""SELECT f.*, epoch, row_number() OVER (PARTITION BY dataset_name, epoch ORDER BY {W.draw(seed, 'dataset_name', 'epoch', 'event_id')}, event_id) - 1 AS idx
          FROM {frames} f JOIN (SELECT DISTINCT dataset_name, epoch FROM located) USING (dataset_name)""",
    }


@job(
    "sample_from_datasets",
    W.sql(
        "v_steps v_mixture",
        "SELECT p, dataset_name, k, epoch, idx, event_id FROM located JOIN ranked USING (dataset_name, epoch, idx)",
        **pick_ctes("v_steps", "SELECT count(*) FROM v_steps", 41),
    ),
)
def sample_from_datasets(spark, d):
    frames = W.step_rows(spark, d).select("dataset_name", "event_id")
    return M.sample_frames(frames, ["event_id"], weights_of(spark, d), frames.count(), 41)


@job(
    "repeat_dataset",
    W.sql(
        "v_steps",
        f"""SELECT dataset_name, event_id, epoch, row_number() OVER (PARTITION BY dataset_name, epoch ORDER BY {W.draw(42, 'dataset_name', 'epoch', 'event_id')}, event_id) - 1 AS idx
        FROM v_steps, (SELECT unnest(range(0, 3)) AS epoch) WHERE epoch < CASE dataset_name WHEN 'ds_a' THEN 3 ELSE 2 END""",
    ),
)
def repeat_dataset(spark, d):
    frames = W.step_rows(spark, d).select("dataset_name", "event_id")
    epochs = spark.createDataFrame([("ds_a", 3), ("ds_b", 2), ("ds_c", 2)], "dataset_name string, n_epochs long")
    return M.epoch_orders(frames, ["event_id"], epochs, 42)


@job(
    "shuffle_frames",
    W.sql(
        "v_steps",
        f"""SELECT event_id, row_number() OVER (ORDER BY {W.draw(43, 'event_id')}, event_id) - 1 AS position, b AS buffer_no,
        b * 1000 + row_number() OVER (PARTITION BY b ORDER BY {W.draw(44, 'event_id')}, event_id) - 1 AS buffered_position
        FROM (SELECT event_id, CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 1000) AS BIGINT) AS b FROM v_steps)""",
    ),
)
def shuffle_frames(spark, d):
    frames = W.step_rows(spark, d).select("event_id")
    buffered = M.buffered_order(frames, "event_id", 1000, 44, ["event_id"]).withColumnRenamed("position", "buffered_position")
    return with_random_position(buffered, [], ["event_id"], 43)


@job(
    "validation_buffer",
    W.sql(
        "v_steps",
        f"""SELECT event_id, row_number() OVER (ORDER BY {W.draw(46, 'event_id')}, event_id) - 1 AS position FROM
        (SELECT event_id FROM v_steps ORDER BY {W.draw(45, 'event_id')}, event_id LIMIT 1000)""",
    ),
)
def validation_buffer(spark, d):
    frames = W.step_rows(spark, d).select("event_id")
    return with_random_position(M.fixed_buffer(frames, ["event_id"], 1000, 45), [], ["event_id"], 46)


@job(
    "batch_frames",
    W.sql("v_steps", "SELECT event_id, CAST(floor(i / 256) AS BIGINT) AS batch_no, CAST(i % 256 AS INT) AS slot FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM v_steps)"),
)
def batch_frames(spark, d):
    return B.in_batches(W.step_rows(spark, d).select("event_id"), "event_id", 256)


@job(
    "proportional_quota",
    W.sql(
        "v_steps v_mixture",
        f"""SELECT r.dataset_name, event_id, CAST(quota AS BIGINT) AS quota FROM
        (SELECT dataset_name, event_id, row_number() OVER (PARTITION BY dataset_name ORDER BY {W.draw(47, 'event_id')}, event_id) AS i FROM v_steps) r
        JOIN quotas q ON r.dataset_name = q.dataset_name AND i <= quota""",
        n="SELECT count(*) // 10 AS n FROM v_steps",
        shares="SELECT dataset_name, pos, weight / sum(weight) OVER () * n AS share, n FROM (SELECT dataset_name, min(pos) AS pos, arg_min(weight, pos) AS weight FROM v_mixture GROUP BY 1), n",
        quotas="""SELECT dataset_name, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, pos DESC) <= n - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS quota FROM shares""",
    ),
)
def proportional_quota(spark, d):
    frames = W.step_rows(spark, d).select("dataset_name", "event_id")
    kept, _ = M.select_mixture(W.mixture(spark), frames.select("dataset_name").distinct())
    return M.stratified_extract(frames, M.quota_table(kept, frames.count() // 10), ["event_id"], 47)


@job(
    "seeded_epochs",
    W.sql(
        "v_examples",
        " UNION ALL ".join(
            f"SELECT {e} AS epoch, example_id, row_number() OVER (ORDER BY {W.draw(7 + e, 'example_id')}, example_id) - 1 AS position FROM v_examples" for e in range(2)
        ),
    ),
)
def seeded_epochs(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("example_id"))
    one = lambda e: with_random_position(rows, [], ["example_id"], B.epoch_seed(7, e)).select(F.lit(e).alias("epoch"), "example_id", "position")
    return one(0).unionByName(one(1))


def frame_keys(standard, options):
    """Narrow plan of all frames that may be drawn, written once."""
    plan = J.plan_frames(standard, options, carry=["event_id", "action"])
    return cut_lineage(J.filter_frames(plan.withColumn("action", F.array("action"))).drop("action"))


@job(
    "interleaved_mixture",
    W.sql(
        "v_steps v_mixture",
        f"""SELECT position, CAST(floor(position / 256) AS BIGINT) AS batch_no, p, dataset_name, epoch, event_id, goal, {sql_wide([normalized_sql(c, 'bounds_q99') for c in ACTIONS], 'a')}
        FROM (SELECT l.p, l.epoch, r.* EXCLUDE (epoch, idx), row_number() OVER (ORDER BY {W.draw(49, 'l.p')}, l.p) - 1 AS position
              FROM located l JOIN ranked r USING (dataset_name, epoch, idx)) JOIN st USING (dataset_name)""",
        st=WIDE_STATS,
        frames=f"""SELECT *, CAST(least(floor({W.draw(21, 'dataset_name', 'episode_id', 'timestep')} * (t_len - (timestep + 1)) + timestep + 1), t_len - 1) AS INT) AS goal
          FROM (SELECT *, count(*) OVER (PARTITION BY episode_id) AS t_len, bool_or(language_instruction <> '') OVER (PARTITION BY episode_id) AS keep FROM v_steps) WHERE keep""",
        **pick_ctes("frames", "SELECT CAST(floor(max(n / sample_weight) FILTER (weight = 1.0)) AS BIGINT) FROM w", 48),
    ),
)
def interleaved_mixture(spark, d):
    """Statistics -> weights -> filters -> sample -> shuffle -> goals of the drawn frames -> batch.

    The epoch is planned on narrow keys; frames, with all they carry, are fetched once at the end.
    """
    steps = W.steps(spark, d)
    stats = pin_small(T.dataset_statistics(steps.withColumnRenamed("state", "proprio")))
    kept, _ = M.select_mixture(W.mixture(spark), stats)
    weights = pin_small(M.mixture_weights(kept, stats))
    standard = T.normalize(steps, stats, "bounds_q99", 7, 0, GRIPPER_MASK).select(
        *KEYS,
        "event_id",
        F.struct("image_primary", "timestep").alias("observation"),
        F.struct("language_instruction").alias("task"),
        "action",
    )
    options = J.TrajectoryOptions(skip_unlabeled=True, goal_strategy="uniform", goal_kwargs={"seed": 21})
    keys = frame_keys(standard, options)
    total = M.effective_length(weights).first()[0]
    sampled = M.sample_frames(keys, ["event_id"], weights, total, 48, sizes=M.sizes_by_name(keys))
    placed = with_random_position(sampled.drop("k", "idx"), [], ["p"], 49)
    out = J.gather_frames(placed, standard, options)
    return out.select(
        "position",
        F.floor(F.col("position") / 256).cast("long").alias("batch_no"),
        "p",
        "dataset_name",
        "epoch",
        "event_id",
        F.col("task.timestep").alias("goal"),
        *wide(F.col("action")[0], "a", 7),
    )


HELD_OUT = "episode_id % 10 = 3"  # episodes of the validation split
BUFFER, PASSES = 500, 2


def side_ctes(side: str, frames: str, n: str, seed: int) -> dict[str, str]:
    """`pick_ctes` under names of one side of an epoch."""
    own = ("frame_sizes", "positions", "drawn_from", "located", "ranked")
    renamed = lambda text: re.sub(rf"\b({'|'.join(own)})\b", rf"{side}_\1", text)
    return {renamed(k): renamed(v) for k, v in pick_ctes(frames, n, seed).items()}


@job(
    "interleaved_validation",
    W.sql(
        "v_steps v_mixture",
        f"""SELECT 'train' AS side, 0 AS pass, row_number() OVER (ORDER BY {W.draw(53, 'p')}, p) - 1 AS position, p, dataset_name, event_id
        FROM train_located JOIN train_ranked USING (dataset_name, epoch, idx)
        UNION ALL """
        + " UNION ALL ".join(
            f"SELECT 'val', {i}, row_number() OVER (ORDER BY {W.draw(60 + i, 'p')}, p) - 1, p, dataset_name, event_id FROM val_located JOIN val_ranked USING (dataset_name, epoch, idx)"
            for i in range(PASSES)
        ),
        labeled="SELECT * FROM (SELECT *, bool_or(language_instruction <> '') OVER (PARTITION BY episode_id) AS keep FROM v_steps) WHERE keep",
        train_frames=f"SELECT * FROM labeled WHERE NOT ({HELD_OUT})",
        val_frames=f"SELECT * FROM labeled WHERE {HELD_OUT}",
        **side_ctes("train", "train_frames", "SELECT count(*) FROM train_frames", 51) | side_ctes("val", "val_frames", str(BUFFER), 52),
    ),
)
def interleaved_validation(spark, d):
    """One epoch of the training split beside passes over a validation buffer: the first frames of the interleaved validation
    split, kept under a version, so that every pass has the same frames in another order."""
    steps = W.steps(spark, d)
    weights = weights_of(spark, d)
    standard = steps.select(*KEYS, "event_id", F.struct("image_primary").alias("observation"), F.struct("language_instruction").alias("task"), "action")
    keys = frame_keys(standard, J.TrajectoryOptions(skip_unlabeled=True)).select("dataset_name", "episode_id", "event_id")
    train, held = keys.filter(f"NOT ({HELD_OUT})"), keys.filter(HELD_OUT)
    names = ["p", "dataset_name", "event_id"]
    sample = lambda frames, n, seed: M.sample_frames(frames, ["event_id"], weights, n, seed, sizes=M.sizes_by_name(frames)).select(*names)
    folder = scratch(spark, "validation")
    out = with_random_position(sample(train, train.count(), 51), [], ["p"], 53).select(F.lit("train").alias("side"), F.lit(0).alias("pass"), "position", *names)
    for i in range(PASSES):
        kept = M.kept_version(spark, folder, "buffer-1", lambda: sample(held, BUFFER, 52))
        one = with_random_position(kept, [], ["p"], 60 + i).select(F.lit("val").alias("side"), F.lit(i).alias("pass"), "position", *names)
        out = out.unionByName(one)
    return out
