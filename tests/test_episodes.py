"""Sequence operators against plain loops, with usual and with tiny segments."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from armature.operators import episodes as E
from armature.operators import motion, ordering
from armature.operators import trajectories as J

SEGMENTS = [1 << 15, 4]  # usual, and so small that every episode is cut several times


def episodes(seed=1, n=25, longest=23):
    """Short and longer episodes, and one that is a third of all rows."""
    rnd = random.Random(seed)
    lengths = [rnd.randint(1, longest) for _ in range(n)]
    lengths.append(sum(lengths) // 2)
    out = {}
    for e, t in enumerate(lengths):
        out[e] = [
            (rnd.choice([0.0, 1.0, 0.5, 0.3, 0.97]), rnd.choice([-1.0, 1.0, 0.0, 0.05]), rnd.choice([0.0, 5e-5, 0.3]), rnd.choice([-1.0, 1.0]))
            for _ in range(t)
        ]
    return out


def table(spark, data):
    rows = [("ds", e, t, *v) for e, steps in data.items() for t, v in enumerate(steps)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "dataset_name string, episode_id long, timestep int, g double, r double, m double, s double")
    return E.with_timestep(df, F.col("timestep"))


def by_episode(df, *columns):
    out = {}
    for row in sorted(df.select("episode_id", "timestep", *columns).collect(), key=lambda x: (x[0], x[1])):
        out.setdefault(row[0], []).append(row[2] if len(columns) == 1 else tuple(row[2:]))
    return out


@pytest.mark.parametrize("rows", SEGMENTS)
def test_binarize_gripper(spark, rows):
    data = episodes()
    want = {}
    for e, steps in data.items():
        carry, out = steps[-1][0], []
        for g, *_ in reversed(steps):
            if g > 0.95:
                carry = 1.0
            elif g < 0.05:
                carry = 0.0
            out.append(carry)
        want[e] = out[::-1]
    assert by_episode(motion.binarize_gripper(table(spark, data), F.col("g"), rows=rows), "gripper") == want


@pytest.mark.parametrize("rows", SEGMENTS)
def test_absolute_gripper(spark, rows):
    data, want = episodes(2), {}
    for e, steps in data.items():
        motions = [1.0 if r < -0.1 else -1.0 if r > 0.1 else 0.0 for _, r, *_ in steps]
        carry = -next((m for m in motions if m), -1.0)
        out = []
        for m in motions:
            carry = m or carry
            out.append(carry / 2 + 0.5)
        want[e] = out
    assert by_episode(motion.absolute_gripper(table(spark, data), F.col("r"), rows=rows), "gripper") == want


@pytest.mark.parametrize("rows", SEGMENTS)
def test_noops_keep_what_the_loop_keeps(spark, rows):
    data, want, renumbered = episodes(3), {}, {}
    for e, steps in data.items():
        kept, marks = [], []
        for _, _, m, s in steps:
            noop = m < 1e-4 and (not kept or s == kept[-1])
            marks.append(noop)
            if not noop:
                kept.append(s)
        want[e] = marks
        if kept:
            renumbered[e] = list(range(len(kept)))
    marked = motion.mark_noops(table(spark, data), F.col("m") < 1e-4, "s", rows=rows)
    assert by_episode(marked, "is_noop") == want
    assert by_episode(motion.without_noops(marked, rows=rows), "demo_step") == renumbered


@pytest.mark.parametrize("rows", SEGMENTS)
def test_neighbours_facts_and_rolling_means(spark, rows):
    data = episodes(4)
    df = table(spark, data).withColumn("v", F.col("timestep") * 1.0)
    near = E.with_neighbours(df, {"a": ("v", -2), "b": ("v", 3)}, rows=rows)
    sized = E.with_length(near, rows=rows)
    rolled = E.with_rolling_means(sized, {"avg": ("v", 3)}, rows=rows)
    want = {}
    for e, steps in data.items():
        t = len(steps)
        want[e] = [
            (i - 2.0 if i >= 2 else None, i + 3.0 if i + 3 < t else None, t, sum(range(max(0, i - 2), i + 1)) / min(3, i + 1)) for i in range(t)
        ]
    got = by_episode(rolled, "a", "b", "episode_len", "avg")
    assert got == {e: [(a, b, n, pytest.approx(m)) for a, b, n, m in v] for e, v in want.items()}


def test_reached_state_drops_the_last_step(spark):
    data = {0: [(0.0,) * 4], 1: [(0.0,) * 4] * 2, 2: [(float(i),) * 4 for i in range(9)]}
    df = table(spark, data).select(
        "dataset_name", "episode_id", "timestep", F.array(*[F.col("g") * (i + 1) for i in range(6)]).alias("state"),
        F.array(*[F.lit(9.0)] * 6, F.col("s")).alias("action"),
    )
    out = by_episode(motion.relabel_by_reached_state(df, F.col("state"), rows=4), "action")
    assert 0 not in out and len(out[1]) == 1
    assert out[2] == [[1.0, 2.0, 3.0, 4.0, 5.0, 6.0, float(t)] for t in range(8)]


@pytest.mark.parametrize("rows", [1 << 15, 16])
@pytest.mark.parametrize("with_goal", [False, True])
def test_chunks_match_index_arithmetic(spark, rows, with_goal):
    window, future, data = 3, 2, episodes(5)
    goals = {e: [random.Random(e * 1000 + t).randint(t, len(s) - 1) for t in range(len(s))] for e, s in data.items()}
    df = table(spark, data).select(
        "dataset_name", "episode_id", "timestep",
        F.struct(F.col("timestep").alias("at")).alias("observation"),
        F.array(F.col("timestep") + 100.0, F.col("timestep") + 200.0).alias("action"),
        F.array(F.lit(False), F.lit(True)).alias("absolute_action_mask"),
        (F.struct(F.lit("x").alias("language_instruction"))).alias("task"),
    )
    if with_goal:
        flat = [(e, t, g) for e, gs in goals.items() for t, g in enumerate(gs)]
        g = spark.createDataFrame(flat, "episode_id long, timestep int, goal int")
        df = df.join(g, ["episode_id", "timestep"]).withColumn("task", F.struct(F.col("goal").alias("timestep"))).drop("goal")
        df = E.with_timestep(df, F.col("timestep"))
    got = by_episode(J.chunk(df, window, future, 2, rows=rows), "observation", "pad_mask", "action")
    for e, steps in data.items():
        t_len = len(steps)
        for t in range(t_len):
            goal = goals[e][t] if with_goal else t_len - 1
            obs, mask, act = got[e][t]
            assert [o["at"] for o in obs] == [max(0, t + k) for k in range(-2, 1)]
            assert mask == [t + k >= 0 for k in range(-2, 1)]
            for k, a in zip(range(-2, 3), act):
                i = min(max(t + k, 0), goal)
                assert a == [0.0 if t + k > goal else i + 100.0, i + 200.0]


def test_positions_do_not_depend_on_partitions(spark):
    rows = [(i % 2 if i % 3 else 0, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, k long")
    got = [
        sorted(map(tuple, ordering.with_random_position(df.repartition(n), ["g"], ["k"], 5).collect())) for n in (1, 7)
    ]
    assert got[0] == got[1]
    for g in (0, 1):
        positions = sorted(p for gg, _, p in got[0] if gg == g)
        assert positions == list(range(len(positions)))


def test_running_totals_cross_blocks(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(100)], "k long, v int")
    out = ordering.with_running_totals(df, [], ["k"], ordering.counter_block(F.col("k"), 7), {"total": F.col("v")})
    got = dict(out.select("k", "total").collect())
    assert got == {i: sum(j % 4 for j in range(i + 1)) for i in range(100)}


@pytest.mark.parametrize("ids", [[i * 10**15 + 3 for i in range(200)], [*range(20_000), 10**17], [i**5 for i in range(3000)]])
def test_blocks_are_even_whatever_the_ids(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "k long").repartition(5)
    sizes = [r["count"] for r in ordering.by_ranges(df, ["k"], 4).groupBy("__block").count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert dict(ordering.with_position(df, [], ["k"]).collect()) == {k: i for i, k in enumerate(ids)}
    grouped = df.withColumn("g", F.col("k") % 2)
    got = {r["k"]: r["position"] for r in ordering.with_position(grouped, ["g"], ["k"]).collect()}
    for g in (0, 1):
        assert [got[k] for k in sorted(i for i in ids if i % 2 == g)] == list(range(sum(i % 2 == g for i in ids)))


def test_long_episode_is_numbered_in_blocks(spark):
    data = [(1, i * 13 % 1000) for i in range(1000)] + [(2, 5)]
    df = spark.createDataFrame(data, "episode_id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    out = E.add_timestep(df, ["episode_id"], ["ts"], ordering.time_block(F.col("ts"), 60))
    assert all(r["timestep"] == r["s"] for r in out.filter("episode_id = 1").collect())


def test_subsample_and_filters(spark):
    data = episodes(6)
    df = table(spark, data).select(
        "dataset_name", "episode_id", "timestep",
        F.struct(F.array("g").alias("proprio")).alias("observation"),
        F.struct(F.when((F.col("episode_id") % 3 == 0) | (F.col("timestep") > 0), "").otherwise("go").alias("language_instruction")).alias("task"),
        F.array(F.when((F.col("episode_id") == 1) & (F.col("timestep") == 0), F.lit(float("nan"))).otherwise(F.col("s"))).alias("action"),
    )
    few = by_episode(J.subsample(df, 5), "draw")
    assert {e: len(v) for e, v in few.items()} == {e: min(5, len(s)) for e, s in data.items()}
    labeled = set(by_episode(J.skip_unlabeled(df, rows=4), "timestep"))
    assert labeled == {e for e in data if e % 3}
    bounded = set(by_episode(J.filter_max(df, F.col("action"), 1.0, rows=4), "timestep"))
    assert bounded == set(data) - {1}
    with pytest.raises(ValueError):
        J.skip_unlabeled(df.withColumn("task", F.struct(F.lit(1).alias("x"))))


def test_goal_is_later_and_carries_its_observation(spark):
    data = episodes(7)
    df = table(spark, data).select(
        "dataset_name", "episode_id", "timestep",
        F.struct(F.concat(F.lit("i"), F.col("timestep").cast("string")).alias("image_primary"), "timestep").alias("observation"),
        F.struct(F.lit("go").alias("language_instruction")).alias("task"),
    )
    out = J.goal_uniform(J.add_pad_masks(df), 3, rows=4)
    got = by_episode(out, "task.timestep", "task.image_primary", "task.language_instruction")
    assert {e: len(v) for e, v in got.items()} == {e: len(v) for e, v in data.items()}
    for e, goals in got.items():
        for t, (g, image, said) in enumerate(goals):
            assert image == f"i{g}" and said == "go"
            assert t < g < len(goals) or (t == len(goals) - 1 == g)


def test_scans_equal_plain_loops_over_tiny_blocks(spark):
    draw = np.random.default_rng(9)
    rows = []
    for episode, n in enumerate([1, 2, 3, 7, 20, 33]):
        for t in range(n):
            rows.append(("d", episode, t, None if draw.random() < 0.6 else float(draw.integers(0, 9)), float(draw.integers(0, 9))))
    df = spark.createDataFrame(rows, "dataset_name string, episode_id long, timestep int, v double, w double")
    v, w = F.col("v"), F.col("w")
    got = E.with_scans(df, forward={"f": v}, backward={"b": v}, following={"n": v, "m": w}, preceding={"p": v}, first={"o": v}, final={"l": v}, position="at", length="size", rows=3)
    assert got.columns == [*df.columns, "f", "b", "n", "m", "p", "o", "l", "at", "size"]
    found = {(r.episode_id, r.timestep): r for r in got.collect()}
    assert len(found) == len(rows)
    known = lambda xs: next((x for x in xs if x is not None), None)
    for (episode, t), r in found.items():
        vs = [x[3] for x in rows if x[1] == episode]
        ws = [x[4] for x in rows if x[1] == episode]
        end = t == len(vs) - 1
        want = (known(vs[t::-1]), known(vs[t:]), None if end else vs[t + 1], None if end else ws[t + 1], vs[t - 1] if t else None, known(vs), vs[-1], t, len(vs))
        assert (r.f, r.b, r.n, r.m, r.p, r.o, r.l, r.at, r["size"]) == want
