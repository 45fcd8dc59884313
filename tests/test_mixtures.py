"""Validation buffers: the least draws without a single-task order, and versions that are written once."""

import pytest
from pyspark.sql import functions as F

from armature.functions.chance import uniform
from armature.operators import mixtures as M
from armature.operators import trajectories as J


@pytest.mark.parametrize("bins", [2, 16, 1 << 16])
@pytest.mark.parametrize("size", [0, 1, 37, 500, 501, 900])
def test_least_draws_equal_an_order_of_all(spark, size, bins):
    df = spark.range(501).withColumnRenamed("id", "event_id")
    got = {r.event_id for r in M.least_draws(df, ["event_id"], size, 5, bins).collect()}
    want = {r.event_id for r in df.orderBy(uniform(5, "event_id"), "event_id").limit(size).collect()}
    assert got == want


def test_least_draws_of_equal_keys(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), "id")
    assert M.least_draws(df, ["k"], 100, 5, 4).count() == 100
    assert M.least_draws(df.limit(0), ["k"], 100, 5, 4).count() == 0


def test_a_version_is_written_once_and_read_by_another_session(spark, tmp_path):
    built = []

    def build(n):
        built.append(n)
        return spark.range(n)

    folder = str(tmp_path / "buffers")
    first = M.kept_version(spark, folder, "v1", lambda: build(5))
    again = M.kept_version(spark.newSession(), folder, "v1", lambda: build(9))
    assert first.count() == again.count() == 5 and built == [5]
    assert M.kept_version(spark, folder, "v2", lambda: build(7)).count() == 7 and built == [5, 7]
    # a folder without a finished write is no version
    (tmp_path / "buffers" / "v3").mkdir()
    assert M.kept_version(spark, folder, "v3", lambda: build(3)).count() == 3


def test_planned_frames_carry_what_the_steps_say(spark):
    """Windows, goals and further actions that are fetched by step number equal those read off the episode."""
    rows = [("d", e, t, (f"i{e}-{t}", [float(t)]), ("go",), [float(t), 1.0], f"x{e}-{t}") for e, n in ((1, 1), (2, 5), (3, 9)) for t in range(n)]
    steps = spark.createDataFrame(rows, "dataset_name string, episode_id long, timestep int, observation struct<image_primary:string,proprio:array<double>>, task struct<language_instruction:string>, action array<double>, extra string")
    options = J.TrajectoryOptions(window=3, future=2, action_dim=2, goal_strategy="uniform", goal_kwargs={"seed": 4})
    plan = J.plan_frames(steps, options)
    assert set(plan.columns) == {"dataset_name", "episode_id", "timestep", "episode_len", "goal_step"}
    goals = {(r.episode_id, r.timestep): r.goal_step for r in plan.collect()}
    got = J.gather_frames(plan, steps, options).collect()
    assert len(got) == len(rows)
    for r in got:
        t, goal = r.timestep, goals[(r.episode_id, r.timestep)]
        assert [o.image_primary for o in r.observation] == [f"i{r.episode_id}-{max(0, t - k)}" for k in (2, 1, 0)]
        assert list(r.pad_mask) == [t >= 2, t >= 1, True]
        assert (r.task.image_primary, r.task.timestep, r.task.language_instruction) == (f"i{r.episode_id}-{goal}", goal, "go")
        assert [a[0] for a in r.action] == [max(0.0, t - 2.0), max(0.0, t - 1.0), float(t), *[float(t + k) if t + k <= goal else 0.0 for k in (1, 2)]]
        assert r.extra == f"x{r.episode_id}-{t}"
    # a frame may be drawn more than once
    twice = plan.withColumn("p", F.explode(F.array(F.lit(0), F.lit(1))))
    assert J.gather_frames(twice, steps, options).count() == 2 * len(rows)
