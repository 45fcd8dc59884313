"""Trajectory transforms on standardized steps.

Input rows: dataset_name, episode_id, timestep, observation (struct), task (struct), action (array of doubles) and,
optionally, absolute_action_mask. The order of the stages in `transform` is part of the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armature.functions.chance import uniform
from armature.operators import layout
from armature.operators.episodes import EPISODE, SEGMENT_ROWS, with_episode_facts, with_length, with_neighbours


def _fields(df: DataFrame, column: str) -> list[str]:
    return [f.name for f in df.schema[column].dataType.fields]


#: Episode facts: some step has an instruction.
LABELED = (F.max, lambda: F.col("task.language_instruction") != "", "max")


def _whole_episodes(df: DataFrame, tests: Mapping[str, tuple], keys: Sequence[str], rows: int, length: bool = False) -> DataFrame:
    """Keep the episodes that pass all tests, name -> (aggregate, condition on a step, how to combine segments), in one go.

    With `length`, `episode_len` is added as well.
    """
    facts = {n: (agg(condition()), how) for n, (agg, condition, how) in tests.items()}
    if length:
        facts["episode_len"] = (F.max("timestep"), "max")
    found = with_episode_facts(df, facts, keys, rows)
    for n in tests:
        found = found.filter(F.col(n))
    found = found.drop(*tests)
    return found.withColumn("episode_len", (F.col("episode_len") + 1).cast("int")) if length else found


def skip_unlabeled(df: DataFrame, keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Keep episodes in which at least one step has an instruction."""
    if "language_instruction" not in _fields(df, "task"):
        raise ValueError("skip_unlabeled needs task.language_instruction")
    return _whole_episodes(df, {"__labeled": LABELED}, keys, rows)


def within(vector: Column, limit: float) -> Column:
    """Every element has absolute value <= limit; NaN has not."""
    return (F.abs(F.array_max(vector)) <= limit) & (F.abs(F.array_min(vector)) <= limit)


def filter_max(df: DataFrame, vector: Column, limit: float, keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Drop whole episodes that leave [-limit, limit] anywhere."""
    return _whole_episodes(df, {"__all": (F.min, lambda: within(vector, limit), "min")}, keys, rows)


def add_pad_masks(df: DataFrame) -> DataFrame:
    """observation.pad_mask_dict and task.pad_mask_dict: which entries are real."""
    marks = {
        c: F.col(c).withField("pad_mask_dict", layout.pad_mask(F.col(c), df.schema[c].dataType)) for c in ("observation", "task")
    }
    return df.withColumns(marks)


def uniform_goal(seed: int = 0, keys: Sequence[str] = EPISODE) -> Column:
    """The number of a uniformly chosen later step, from `timestep` and `episode_len`; the last step is its own goal."""
    t = F.col("timestep")
    u = uniform(seed, *keys, "timestep")
    return F.least(F.floor(u * (F.col("episode_len") - (t + 1)) + t + 1).cast("int"), F.col("episode_len") - 1)


def with_observed_time(df: DataFrame) -> DataFrame:
    if "timestep" in _fields(df, "observation"):
        return df
    return df.withColumn("observation", F.col("observation").withField("timestep", F.col("timestep")))


def goal_uniform(df: DataFrame, seed: int = 0, keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Give each step a uniformly chosen later step as goal and merge that step's observation into `task`.

    The gather is an equi-join on (episode, goal step): its key is unique per step, so no episode is a hot key.
    """
    timed = with_observed_time(df)
    left = with_length(timed, keys, rows).withColumn("__goal", uniform_goal(seed, keys))
    left = left if "episode_len" in df.columns else left.drop("episode_len")
    right = timed.select(*keys, F.col("timestep").alias("__goal"), F.col("observation").alias("__seen"))
    joined = left.join(right, [*keys, "__goal"])
    merged = layout.merge_trees(
        F.col("task"), timed.schema["task"].dataType, F.col("__seen"), timed.schema["observation"].dataType
    )
    return joined.withColumn("task", merged).drop("__goal", "__seen")


def delete_task_conditioning(
    df: DataFrame, keep_image_prob: float, seed: int = 0, keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Per step, keep either the goal images or the instruction; the other becomes padding."""
    names = _fields(df, "task")
    images = [n for n in names if n.startswith(("image_", "depth_"))]
    if "language_instruction" not in names or not images:
        return df
    kinds = {f.name: f.dataType for f in df.schema["task"].dataType.fields}
    sized = with_length(df, keys, rows).withColumn(
        "__images",
        (uniform(seed, *keys, "timestep") < keep_image_prob) | ~F.col("task.pad_mask_dict.language_instruction"),
    )
    task = F.col("task")
    for name in [*images, "language_instruction"]:
        keep = F.col("__images") if name in images else ~F.col("__images")
        value, real = F.col(f"task.{name}"), F.col(f"task.pad_mask_dict.{name}")
        task = task.withField(name, F.when(keep, value).otherwise(layout.padding_of(value, kinds[name])))
        task = task.withField(f"pad_mask_dict.{name}", keep & real)
    goal = F.when(F.col("__images"), F.col("task.timestep")).otherwise(F.col("episode_len") - 1)
    out = sized.withColumn("task", task.withField("timestep", goal)).drop("__images")
    return out if "episode_len" in df.columns else out.drop("episode_len")


def chunk(
    df: DataFrame, window: int, future: int, action_dim: int, keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Windows of steps: `observation` becomes an array of `window` past..current entries with a `pad_mask` array beside
    it, `action` an array of window + future vectors.

    Steps before the episode repeat its first step. Actions after the goal are neutral: absolute dimensions repeat the
    goal's value, relative ones are zero. Needs a few neighbours per step, never the whole episode.
    """
    shifts = {f"__o{k}": ("observation", -k) for k in range(1, window)}
    shifts |= {f"__p{k}": ("action", -k) for k in range(1, window)}
    shifts |= {f"__n{k}": ("action", k) for k in range(1, future + 1)}
    has_goal = "timestep" in _fields(df, "task")
    base = df if has_goal else with_length(df, keys, rows)
    near = with_neighbours(base, shifts, keys, rows) if shifts else base
    return _chunked(near, window, future, action_dim)


def _chunked(near: DataFrame, window: int, future: int, action_dim: int) -> DataFrame:
    """Windows from the neighbours that stand in the row already: __o1, __p1, ... before it and __n1, ... after it."""
    shifts = [*[f"__{kind}{k}" for k in range(1, window) for kind in "op"], *[f"__n{k}" for k in range(1, future + 1)]]
    has_goal = "timestep" in _fields(near, "task")
    t = F.col("timestep")
    goal = F.col("task.timestep") if has_goal else F.col("episode_len") - 1

    def past(prefix: str, current: str, k: int) -> Column:
        return F.coalesce(*[F.col(f"{prefix}{j}") for j in range(k, 0, -1)], F.col(current))

    observations = [past("__o", "observation", k) for k in range(window - 1, 0, -1)] + [F.col("observation")]
    actions = [past("__p", "action", k) for k in range(window - 1, 0, -1)] + [F.col("action")]
    ahead = F.array(F.col("action"), *[F.col(f"__n{k}") for k in range(1, future + 1)])
    absolute = F.col("absolute_action_mask") if "absolute_action_mask" in near.columns else None
    for k in range(1, future + 1):
        reached = F.element_at(ahead, F.least(F.lit(k), goal - t).cast("int") + 1)
        still = [
            F.when(absolute[i], reached[i]).otherwise(0.0) if absolute is not None else F.lit(0.0) for i in range(action_dim)
        ]
        actions.append(F.when(goal - t < k, F.array(*still)).otherwise(reached))
    out = near.withColumns(
        {
            "observation": F.array(*observations),
            "pad_mask": F.array(*[t >= k for k in range(window - 1, -1, -1)]),
            "action": F.array(*actions),
        }
    )
    return out.drop(*shifts, "episode_len")


def subsample(df: DataFrame, n: int, seed: int = 0, keys: Sequence[str] = EPISODE) -> DataFrame:
    """At most `n` random steps per episode, in the order they were drawn (`draw`); shorter episodes keep theirs.

    The rank filter becomes a per-task limit before the shuffle, so a long episode sends n rows per task, not all.
    """
    w = Window.partitionBy(*keys).orderBy("__u", "timestep")
    drawn = df.withColumn("__u", uniform(seed, *keys, "timestep"))
    return drawn.withColumn("draw", F.row_number().over(w)).filter(F.col("draw") <= n).drop("__u")


#: Goal relabeling and task augmentation are chosen by name.
GOAL_STEPS: dict[str, Callable[..., Column]] = {"uniform": uniform_goal}
TASK_STRATEGIES: dict[str, Callable[..., DataFrame]] = {"delete_task_conditioning": delete_task_conditioning}


@dataclass(frozen=True)
class TrajectoryOptions:
    window: int = 1
    future: int = 0
    action_dim: int = 7
    skip_unlabeled: bool = False
    max_action: float | None = None
    max_proprio: float | None = None
    goal_strategy: str | None = None
    goal_kwargs: Mapping = field(default_factory=dict)
    task_strategy: str | None = None
    task_kwargs: Mapping = field(default_factory=dict)
    subsample: int | None = None
    subsample_seed: int = 0


def _episode_tests(steps: DataFrame, o: TrajectoryOptions) -> dict[str, tuple]:
    tests = {}
    if o.skip_unlabeled:
        if "language_instruction" not in _fields(steps, "task"):
            raise ValueError("skip_unlabeled needs task.language_instruction")
        tests["__labeled"] = LABELED
    if o.max_action is not None:
        tests["__action"] = (F.min, lambda: within(F.col("action"), o.max_action), "min")
    if o.max_proprio is not None and "proprio" in _fields(steps, "observation"):
        tests["__proprio"] = (F.min, lambda: within(F.col("observation.proprio"), o.max_proprio), "min")
    return tests


def plan_frames(steps: DataFrame, options: TrajectoryOptions, train: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """The frames that `transform` gives, as step numbers: episode, `timestep`, `episode_len`, `goal_step` if there are goals, `draw`
    if episodes are subsampled, and the columns `carry`.

    Narrow rows: of the observations only what the filters look at is read, and nothing of them is shuffled.
    """
    plan = _whole_episodes(steps, _episode_tests(steps, options), EPISODE, SEGMENT_ROWS, length=True)
    plan = plan.select(*EPISODE, "timestep", "episode_len", *carry)
    if options.goal_strategy is not None:
        plan = plan.withColumn("goal_step", GOAL_STEPS[options.goal_strategy](**options.goal_kwargs))
    if train and options.subsample is not None:
        plan = subsample(plan, options.subsample, options.subsample_seed)
    return plan


def gather_frames(plan: DataFrame, steps: DataFrame, options: TrajectoryOptions, train: bool = True) -> DataFrame:
    """The frames of a plan with what they carry: every step that a frame needs (itself, its goal, its window) is fetched once, by
    (episode, step), and the rest is arithmetic inside a row.

    A plan may name a frame several times if a further column of it tells these apart; its rows must differ.
    """
    o = options
    masked = add_pad_masks(steps)
    has_goal = o.goal_strategy is not None
    masked = with_observed_time(masked) if has_goal else masked
    t, last = F.col("timestep"), F.col("episode_len") - 1
    wanted = [t, *[F.greatest(t - k, F.lit(0)) for k in range(1, o.window)], *[F.least(t + k, last) for k in range(1, o.future + 1)]]
    wanted += [F.col("goal_step")] if has_goal else []
    carried = [c for c in masked.columns if c not in (*EPISODE, "timestep")]
    own = [c for c in carried if c not in ("observation", "action") and c not in plan.columns]
    row = lambda is_own: F.struct("observation", "action", *[F.when(is_own, F.col(c)).alias(c) for c in own])
    seen = masked.select(*EPISODE, F.col("timestep").alias("__step"), *["observation", "action", *own])
    if len(wanted) == 1:
        frames = plan.join(seen.withColumnRenamed("__step", "timestep"), [*EPISODE, "timestep"])
    else:
        asked = plan.withColumn("__step", F.explode(F.array_distinct(F.array(*wanted))))
        found = asked.join(seen, [*EPISODE, "__step"])
        rows = found.groupBy(*plan.columns).agg(F.map_from_entries(F.collect_list(F.struct("__step", row(F.col("__step") == t).alias("row")))).alias("__rows"))
        at = lambda step, name: F.element_at("__rows", step)[name]
        near = {f"__{kind}{k}": F.when(t >= k, at(t - k, name)) for k in range(1, o.window) for kind, name in (("o", "observation"), ("p", "action"))}
        near |= {f"__n{k}": F.when(t + k <= last, at(t + k, "action")) for k in range(1, o.future + 1)}
        near |= {"__seen": at(F.col("goal_step"), "observation")} if has_goal else {}
        frames = rows.select(*plan.columns, *[at(t, c).alias(c) for c in ("observation", "action", *own)], *[c.alias(n) for n, c in near.items()])
    if has_goal:
        frames = frames.withColumn("task", layout.merge_trees(F.col("task"), masked.schema["task"].dataType, F.col("__seen"), masked.schema["observation"].dataType))
        frames = frames.drop("__seen")
    if train and o.task_strategy is not None:
        frames = TASK_STRATEGIES[o.task_strategy](frames, **o.task_kwargs)
    return _chunked(frames, o.window, o.future, o.action_dim).drop("goal_step")


def transform(steps: DataFrame, options: TrajectoryOptions, train: bool = True) -> DataFrame:
    """Filters, masks, goals, augmentation, chunks, subsample: in this order.

    What is asked of whole episodes, by the filters and by the stages that need their length, is gathered in one pass. Where
    frames need other steps, they are planned as step numbers first (`plan_frames`) and fetched once (`gather_frames`).
    """
    o = options
    if o.goal_strategy is not None or o.window > 1 or o.future > 0:
        return gather_frames(plan_frames(steps, o, train), steps, o, train)
    df = add_pad_masks(_whole_episodes(steps, _episode_tests(steps, o), EPISODE, SEGMENT_ROWS, length=True))
    if train and o.task_strategy is not None:
        df = TASK_STRATEGIES[o.task_strategy](df, **o.task_kwargs)
    df = chunk(df, o.window, o.future, o.action_dim)
    if train and o.subsample is not None:
        df = subsample(df, o.subsample, o.subsample_seed)
    return df


# 1 % and 99 % action quantiles that the zero filter assumes.
ZERO_FILTER_Q01 = [
    -0.7776297926902771, -0.5803514122962952, -0.5795090794563293, -0.6464047729969025, -0.7041108310222626, -0.8895104378461838,
]
ZERO_FILTER_Q99 = [
    0.7597932070493698, 0.5726242214441299, 0.7351000607013702, 0.6705610305070877, 0.6464948207139969, 0.8897542208433151,
]


def normalized_zero() -> list[float]:
    return [2 * (0.0 - lo) / (hi - lo + 1e-8) - 1 for lo, hi in zip(ZERO_FILTER_Q01, ZERO_FILTER_Q99)]


def moves(actions: Column) -> Column:
    """A chunk of normalized actions in which some motion dimension of some row is not the normalized zero."""

    def row(a: Column) -> Column:
        hit = F.lit(False)
        for i, zero in enumerate(normalized_zero()):
            hit = hit | (F.abs(a[i] - F.lit(zero)) > 1e-5)
        return hit

    return F.exists(actions, row)


#: Frame predicates attached to datasets by name.
FRAME_FILTERS: dict[str, Callable[[], Column]] = {"droid": lambda: moves(F.col("action"))}


def filter_frames(frames: DataFrame, filters: Mapping[str, Callable[[], Column]] | None = None) -> DataFrame:
    """Apply each dataset's own frame predicate; datasets without one keep all their frames."""
    keep = F.lit(True)
    for dataset, predicate in (FRAME_FILTERS if filters is None else filters).items():
        keep = F.when(F.col("dataset_name") == dataset, predicate()).otherwise(keep)
    return frames.filter(keep)
