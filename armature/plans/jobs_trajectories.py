"""Statistics, normalization, trajectory and image jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.functions import vectors as V
from armature.operators import episodes as E
from armature.operators import images as G
from armature.operators import layout as L
from armature.operators import statistics as T
from armature.operators import trajectories as J
from armature.operators import unnormalize as U
from armature.operators.smallside import pin_small
from armature.plans import views as W
from armature.plans.jobs_sources import ACTIONS, LONG_STEPS, STAT_COLUMNS, STATES, STATS_SQL, exploded, with_state
from armature.plans.registry import job, r6, sql_r6, sql_wide, text_of, wide
from armature.sources import tables

KEY = "dataset_name, episode_id, timestep"
KEYS = ["dataset_name", "episode_id", "timestep"]
GRIPPER_MASK = [True] * 6 + [False]

# Statistics and normalization ----------------------------------------------------------------------------------------


@job("dataset_statistics", W.sql("v_steps", f"SELECT dataset_name, key, dim, {STAT_COLUMNS} FROM st", long=LONG_STEPS, st=STATS_SQL))
def dataset_statistics(spark, d):
    return exploded(T.dataset_statistics(with_state(spark, d)))


@job(
    "approx_statistics",
    W.sql("v_steps", f"SELECT dataset_name, key, dim, {', '.join(sql_r6(s, s) for s in ('mean', 'std', 'min', 'max'))}, TRUE AS q01_in_bounds, TRUE AS q99_in_bounds FROM st", long=LONG_STEPS, st=STATS_SQL),
)
def approx_statistics(spark, d):
    """The sketch promises ranks: each quantile is a value whose rank is within rows / accuracy of the wanted one."""
    steps = with_state(spark, d)
    found = T.dimension_statistics(steps, approximate=True)
    ranks = T.quantile_ranks(T.long_values(steps), found)
    return ranks.select("dataset_name", "key", "dim", *[r6(c).alias(c) for c in ("mean", "std", "min", "max")], "q01_in_bounds", "q99_in_bounds")


WIDE_STATS = (
    "SELECT dataset_name, "
    + ", ".join(
        f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}, "
        f"quantile_cont({c}, 0.01) AS q01_{c}, quantile_cont({c}, 0.99) AS q99_{c}"
        for c in ACTIONS + STATES
    )
    + " FROM v_steps GROUP BY 1"
)


def normalized_sql(c: str, how: str) -> str:
    if how == "normal":
        scaled = f"({c} - mean_{c}) / (std_{c} + 1e-8)"
        return c if c == "a6" else scaled
    low, high = ("min", "max") if how == "bounds" else ("q01", "q99")
    scaled = f"greatest(-1e0, least(1e0, 2 * ({c} - {low}_{c}) / ({high}_{c} - {low}_{c} + 1e-8) - 1))"
    return f"CASE WHEN min_{c} = max_{c} THEN 0e0 ELSE {c if c == 'a6' else scaled} END"


def _normalize_sql(how: str) -> str:
    a = sql_wide([normalized_sql(c, how) for c in ACTIONS], "a")
    p = sql_wide([normalized_sql(c, how) for c in STATES], "p")
    return W.sql("v_steps", f"SELECT event_id, {a}, {p} FROM v_steps JOIN st USING (dataset_name)", st=WIDE_STATS)


def _normalized(spark, d, how):
    steps = with_state(spark, d)
    stats = pin_small(T.dataset_statistics(steps, quantiles=how == "bounds_q99"))
    out = T.normalize(steps, stats, how, 7, 8, GRIPPER_MASK)
    return out.select("event_id", *wide("action", "a", 7), *wide("proprio", "p", 8))


@job("normalize_gaussian", _normalize_sql("normal"))
def normalize_gaussian(spark, d):
    return _normalized(spark, d, "normal")


@job("normalize_bounds", _normalize_sql("bounds"))
def normalize_bounds(spark, d):
    return _normalized(spark, d, "bounds")


@job("normalize_bounds_q99", _normalize_sql("bounds_q99"))
def normalize_bounds_q99(spark, d):
    return _normalized(spark, d, "bounds_q99")


@job(
    "normalization_mask",
    W.sql("v_steps", f"SELECT dataset_name, dim, dim < 6 AS mask, {sql_r6('q01', 'q01')}, {sql_r6('q99', 'q99')} FROM st WHERE key = 'action'", long=LONG_STEPS, st=STATS_SQL),
)
def normalization_mask(spark, d):
    stats = U.with_mask(T.dataset_statistics(with_state(spark, d)), GRIPPER_MASK)
    z = F.posexplode(F.arrays_zip(*[F.col(f"action.{n}").alias(n) for n in ("mask", "q01", "q99")])).alias("dim", "z")
    return stats.select("dataset_name", z).select("dataset_name", "dim", "z.mask", r6("z.q01").alias("q01"), r6("z.q99").alias("q99"))


CENTRE = "((-1 + least(greatest({b} - 1, 0), 254) * (2e0 / 255)) + (-1 + (least(greatest({b} - 1, 0), 254) + 1) * (2e0 / 255))) / 2"


@job(
    "unnormalize_action",
    W.sql(
        "v_steps v_preds",
        "SELECT sample_id, "
        + sql_wide([f"0.5 * (x + 1) * (q99_{c} - q01_{c}) + q01_{c}" for c in ACTIONS[:6]] + ["x"], "u")
        + f" FROM (SELECT *, {CENTRE.format(b='pred_bin')} AS x FROM v_preds) JOIN st USING (dataset_name)",
        st=WIDE_STATS,
    ),
)
def unnormalize_action(spark, d):
    stats = U.with_mask(T.dataset_statistics(with_state(spark, d)), GRIPPER_MASK)
    preds = W.predictions(spark, d).withColumn("unnorm_key", F.col("dataset_name"))
    centre = A.action_of_token(A.token_of_bin(F.col("pred_bin")))
    rows = U.resolve_keys(preds, pin_small(stats)).withColumn("normalized", F.array(*[centre] * 7))
    return U.unnormalize(rows, "normalized", 7).select("sample_id", *wide("unnormalized", "u", 7))


@job(
    "resolve_unnorm_key",
    W.sql(
        "v_steps v_preds",
        f"""SELECT sample_id, CASE WHEN dataset_name = 'ds_b' THEN 'ds_b_no_noops' ELSE dataset_name END AS resolved_key, 7 AS action_dim,
        {sql_r6('q99_a0', 'a0_q99')} FROM v_preds JOIN st USING (dataset_name)""",
        st=WIDE_STATS,
    ),
)
def resolve_unnorm_key(spark, d):
    stats = T.dataset_statistics(with_state(spark, d))
    renamed = F.when(F.col("dataset_name") == "ds_b", "ds_b_no_noops").otherwise(F.col("dataset_name"))
    known = pin_small(stats.withColumn("dataset_name", renamed))
    preds = W.predictions(spark, d).withColumn("unnorm_key", F.col("dataset_name"))
    return U.resolve_keys(preds, known).select(
        "sample_id", "resolved_key", "action_dim", r6(F.col("action_stats.q99")[0]).alias("a0_q99")
    )


# Trajectory transforms ------------------------------------------------------------------------------------------------


def standard(spark, d):
    """Standardized steps: observation, task, action."""
    return W.steps(spark, d).select(
        *KEYS,
        "event_id",
        F.struct("image_primary", F.col("state").alias("proprio"), "timestep").alias("observation"),
        F.struct("language_instruction").alias("task"),
        "action",
        F.array(*[F.lit(i == 6) for i in range(7)]).alias("absolute_action_mask"),
    )


def episode_filter_sql(condition: str, table: str = "v_steps") -> str:
    return f"SELECT *, {condition} OVER (PARTITION BY episode_id) AS keep FROM {table}"


@job("skip_unlabeled", W.sql("v_steps", f"SELECT {KEY}, event_id FROM k WHERE keep", k=episode_filter_sql("bool_or(language_instruction <> '')")))
def skip_unlabeled(spark, d):
    return J.skip_unlabeled(standard(spark, d)).select(*KEYS, "event_id")


NORMAL_ACTIONS = {
    "st": WIDE_STATS,
    "n": "SELECT episode_id, dataset_name, timestep, event_id, "
    + ", ".join(f"{normalized_sql(c, 'normal')} AS {c}" for c in ACTIONS + STATES)
    + " FROM v_steps JOIN st USING (dataset_name)",
}


def all_within(columns: list[str], limit: float) -> str:
    return "bool_and(" + " AND ".join(f"abs({c}) <= {limit}" for c in columns) + ")"


def gaussian_steps(spark, d):
    steps = W.steps(spark, d).withColumnRenamed("state", "proprio")
    stats = pin_small(T.dataset_statistics(with_state(spark, d), quantiles=False))
    return T.normalize(steps, stats, "normal", 7, 8, GRIPPER_MASK)


@job("filter_max_action", W.sql("v_steps", f"SELECT {KEY}, event_id FROM k WHERE keep", **NORMAL_ACTIONS, k=episode_filter_sql(all_within(ACTIONS, 5.5), "n")))
def filter_max_action(spark, d):
    return J.filter_max(gaussian_steps(spark, d), F.col("action"), 5.5).select(*KEYS, "event_id")


@job("filter_max_proprio", W.sql("v_steps", f"SELECT {KEY}, event_id FROM k WHERE keep", **NORMAL_ACTIONS, k=episode_filter_sql(all_within(STATES, 5.5), "n")))
def filter_max_proprio(spark, d):
    return J.filter_max(gaussian_steps(spark, d), F.col("proprio"), 5.5).select(*KEYS, "event_id")


@job(
    "add_pad_mask_dict",
    W.sql("v_steps", "SELECT event_id, image_primary <> '' AS image_real, TRUE AS proprio_real, TRUE AS timestep_real, language_instruction <> '' AS language_real FROM v_steps"),
)
def add_pad_mask_dict(spark, d):
    out = J.add_pad_masks(standard(spark, d))
    o, t = "observation.pad_mask_dict", "task.pad_mask_dict"
    return out.select(
        "event_id",
        F.col(f"{o}.image_primary").alias("image_real"),
        F.col(f"{o}.proprio").alias("proprio_real"),
        F.col(f"{o}.timestep").alias("timestep_real"),
        F.col(f"{t}.language_instruction").alias("language_real"),
    )


U_STEP = lambda seed: W.draw(seed, "dataset_name", "episode_id", "timestep")
GOAL_CTES = {
    "g": f"""SELECT *, CAST(least(floor({U_STEP(21)} * (t_len - (timestep + 1)) + timestep + 1), t_len - 1) AS INT) AS goal
      FROM (SELECT *, count(*) OVER (PARTITION BY episode_id) AS t_len FROM {{t}})""",
    "goals": """SELECT g.*, o.image_primary AS goal_image, o.event_id AS goal_event, o.s0 AS goal_s0
      FROM g JOIN v_steps o ON g.episode_id = o.episode_id AND g.goal = o.timestep""",
}


def goal_ctes(table: str) -> dict[str, str]:
    return {"g": GOAL_CTES["g"].format(t=table), "goals": GOAL_CTES["goals"]}


@job(
    "goal_relabel_uniform",
    W.sql("v_steps", f"SELECT {KEY}, language_instruction, goal AS goal_timestep, goal_image, {sql_r6('goal_s0', 'goal_s0')}, goal_image <> '' AS goal_real FROM goals", **goal_ctes("v_steps")),
)
def goal_relabel_uniform(spark, d):
    out = J.goal_uniform(J.add_pad_masks(standard(spark, d)), 21)
    return out.select(
        *KEYS,
        "task.language_instruction",
        F.col("task.timestep").alias("goal_timestep"),
        F.col("task.image_primary").alias("goal_image"),
        r6(F.col("task.proprio")[0]).alias("goal_s0"),
        F.col("task.pad_mask_dict.image_primary").alias("goal_real"),
    )


AUGMENT_CTES = {
    "aug": f"SELECT *, {U_STEP(22)} < 0.5 OR language_instruction = '' AS keep_image FROM goals",
}


@job(
    "delete_task_conditioning",
    W.sql(
        "v_steps",
        f"""SELECT {KEY}, CASE WHEN keep_image THEN '' ELSE language_instruction END AS language_instruction,
        CASE WHEN keep_image THEN goal_image ELSE '' END AS goal_image, keep_image AND goal_image <> '' AS goal_real,
        NOT keep_image AND language_instruction <> '' AS language_real,
        CAST(CASE WHEN keep_image THEN goal ELSE t_len - 1 END AS INT) AS goal_timestep FROM aug""",
        **goal_ctes("v_steps"),
        **AUGMENT_CTES,
    ),
)
def delete_task_conditioning(spark, d):
    out = J.delete_task_conditioning(J.goal_uniform(J.add_pad_masks(standard(spark, d)), 21), 0.5, 22)
    return out.select(
        *KEYS,
        "task.language_instruction",
        F.col("task.image_primary").alias("goal_image"),
        F.col("task.pad_mask_dict.image_primary").alias("goal_real"),
        F.col("task.pad_mask_dict.language_instruction").alias("language_real"),
        F.col("task.timestep").alias("goal_timestep"),
    )


def short_standard(spark, d):
    """Short episodes: one per user and day."""
    rows = W.short_steps(spark, d)
    return E.with_timestep(
        rows.withColumn("episode_id", F.concat_ws("/", "episode_id", F.col("day").cast("string"))),
        F.col("timestep"),
    ).select(
        *KEYS,
        "event_id",
        F.struct("image_primary").alias("observation"),
        F.struct("language_instruction").alias("task"),
        "action",
        F.array(*[F.lit(i == 6) for i in range(7)]).alias("absolute_action_mask"),
    )


SHORT = "episode_id, day"


@job(
    "chunk_observations",
    W.sql(
        "v_short",
        f"""SELECT event_id, concat_ws(',', coalesce(lag(image_primary, 2) OVER w, lag(image_primary, 1) OVER w, image_primary),
        coalesce(lag(image_primary, 1) OVER w, image_primary), image_primary) AS images,
        concat_ws(',', CAST(timestep >= 2 AS VARCHAR), CAST(timestep >= 1 AS VARCHAR), 'true') AS pad_mask
        FROM v_short WINDOW w AS (PARTITION BY {SHORT} ORDER BY timestep)""",
    ),
)
def chunk_observations(spark, d):
    out = J.chunk(short_standard(spark, d), 3, 0, 7)
    return out.select("event_id", F.array_join("observation.image_primary", ",").alias("images"), text_of(F.col("pad_mask")).alias("pad_mask"))


def chunk_sql(c: str, absolute: bool, window: int, future: int, goal: str) -> list[str]:
    out = []
    for o in range(-window + 1, future + 1):
        if o <= 0:
            out.append("coalesce(" + ", ".join([f"lag({c}, {k}) OVER w" for k in range(-o, 0, -1)] + [c]) + ")")
        else:
            seen = "CASE " + " ".join(f"WHEN {goal} - timestep = {k} THEN lead({c}, {k}) OVER w" for k in range(1, o)) + f" WHEN {goal} - timestep = 0 THEN {c} ELSE lead({c}, {o}) OVER w END"
            out.append(seen if absolute else f"CASE WHEN {goal} - timestep < {o} THEN 0e0 ELSE lead({c}, {o}) OVER w END")
    return out


@job(
    "chunk_actions",
    W.sql(
        "v_short",
        f"SELECT event_id, {sql_wide(chunk_sql('a0', False, 3, 2, '(t_len - 1)'), 'a0_')}, {sql_wide(chunk_sql('a6', True, 3, 2, '(t_len - 1)'), 'a6_')} "
        f"FROM n WINDOW w AS (PARTITION BY {SHORT} ORDER BY timestep)",
        n=f"SELECT *, count(*) OVER (PARTITION BY {SHORT}) AS t_len FROM v_short",
    ),
)
def chunk_actions(spark, d):
    out = J.chunk(short_standard(spark, d), 3, 2, 7)
    dims = lambda dim: [r6(F.col("action")[k][dim]).alias(f"a{dim}_{k}") for k in range(5)]
    return out.select("event_id", *dims(0), *dims(6))


@job(
    "subsample_episode",
    W.sql(
        "v_steps",
        f"SELECT {KEY}, draw FROM r WHERE draw <= 20",
        r=f"SELECT *, CAST(row_number() OVER (PARTITION BY episode_id ORDER BY {U_STEP(23)}, timestep) AS INT) AS draw FROM v_steps",
    ),
)
def subsample_episode(spark, d):
    return J.subsample(W.steps(spark, d), 20, 23).select(*KEYS, "draw")


@job("flatten_to_frames", W.sql("v_steps", f"SELECT {KEY}, event_id, image_primary FROM v_steps"))
def flatten_to_frames(spark, d):
    nested = E.in_parts(W.steps(spark, d), ["event_id", "image_primary"])
    return nested.select("dataset_name", "episode_id", F.inline("steps"))


@job("chunk_filter", W.sql("v_steps", "SELECT dataset_name, event_id FROM v_steps WHERE dataset_name <> 'ds_b' OR a0 > 0"))
def chunk_filter(spark, d):
    hooks = {"ds_b": lambda: F.col("action")[0] > 0}
    return J.filter_frames(W.step_rows(spark, d), hooks).select("dataset_name", "event_id")


@job("zero_action_filter", W.sql("v_steps", "SELECT event_id FROM v_steps WHERE event_id % 5 > 1"))
def zero_action_filter(spark, d):
    """Every fifth chunk stands still, the next moves by half the threshold and goes as well, the next by twice and stays."""
    off = F.when(F.col("event_id") % 5 == 1, 5e-6).when(F.col("event_id") % 5 == 2, -2e-5).otherwise(0.0)
    still = lambda d: F.array(*[F.lit(z) + (d if i == 3 else 0.0) for i, z in enumerate(J.normalized_zero())], F.lit(1.0))
    none = still(F.lit(0.0))
    rows = W.step_rows(spark, d).withColumns(
        {
            "dataset_name": F.lit("droid"),
            "action": F.when(F.col("event_id") % 5 <= 2, F.array(none, still(off))).otherwise(F.array(none, F.col("action"))),
        }
    )
    return J.filter_frames(rows).select("event_id")


OPTIONS = J.TrajectoryOptions(
    window=2,
    future=1,
    skip_unlabeled=True,
    max_action=1000.0,
    max_proprio=450.0,
    goal_strategy="uniform",
    goal_kwargs={"seed": 21},
    task_strategy="delete_task_conditioning",
    task_kwargs={"keep_image_prob": 0.5, "seed": 22},
    subsample=30,
    subsample_seed=23,
)
STAGES = {
    "kept": "SELECT * FROM (SELECT *, bool_or(language_instruction <> '') OVER p AND "
    + all_within(STATES, 450.0)
    + " OVER p AS ok FROM v_steps WINDOW p AS (PARTITION BY episode_id)) WHERE ok",
    **goal_ctes("kept"),
    **AUGMENT_CTES,
    "timed": "SELECT *, CASE WHEN keep_image THEN goal ELSE t_len - 1 END AS goal_t FROM aug",
    "chunks": f"""SELECT *, {', '.join(f'{x} AS a0_{i}' for i, x in enumerate(chunk_sql('a0', False, 2, 1, 'goal_t')))},
      {', '.join(f'{x} AS a6_{i}' for i, x in enumerate(chunk_sql('a6', True, 2, 1, 'goal_t')))},
      coalesce(lag(image_primary) OVER w, image_primary) AS image_before,
      row_number() OVER (PARTITION BY episode_id ORDER BY {U_STEP(23)}, timestep) AS draw
      FROM timed WINDOW w AS (PARTITION BY episode_id ORDER BY timestep)""",
}


@job(
    "trajectory_transforms",
    W.sql(
        "v_steps",
        f"""SELECT {KEY}, CAST(goal_t AS INT) AS goal_timestep, CASE WHEN keep_image THEN '' ELSE language_instruction END AS language_instruction,
        image_before, image_primary, timestep >= 1 AS before_real, {sql_wide(['a0_0', 'a0_1', 'a0_2'], 'a0_')}, {sql_wide(['a6_0', 'a6_1', 'a6_2'], 'a6_')}
        FROM chunks WHERE draw <= 30""",
        **STAGES,
    ),
)
def trajectory_transforms(spark, d):
    out = J.transform(standard(spark, d), OPTIONS)
    dims = lambda dim: [r6(F.col("action")[k][dim]).alias(f"a{dim}_{k}") for k in range(3)]
    image = lambda k: F.col("observation")[k]["image_primary"]
    return out.select(
        *KEYS,
        F.col("task.timestep").alias("goal_timestep"),
        "task.language_instruction",
        image(0).alias("image_before"),
        image(1).alias("image_primary"),
        F.col("pad_mask")[0].alias("before_real"),
        *dims(0),
        *dims(6),
    )


NORMALIZED = ", ".join(f"{normalized_sql(c, 'bounds_q99')} AS n_{c}" for c in ACTIONS)


def single_dataset(spark, d, dataset):
    """Frames of one dataset with its statistics: restructure, statistics, normalize, trajectory transforms."""
    raw = W.steps(spark, d).filter(F.col("dataset_name") == dataset)
    stats = pin_small(T.dataset_statistics(raw.withColumnRenamed("state", "proprio")))
    normalized = T.normalize(raw, stats, "bounds_q99", 7, 0, GRIPPER_MASK)
    steps = normalized.select(
        *KEYS,
        F.struct("image_primary", "timestep").alias("observation"),
        F.struct("language_instruction").alias("task"),
        "action",
    )
    return J.transform(steps, J.TrajectoryOptions(skip_unlabeled=True, max_action=1.0)), stats


@job(
    "single_dataset_frames",
    W.sql(
        "v_steps",
        f"""SELECT dataset_name, episode_id, CAST(floor(timestep / 1024) AS BIGINT) AS part, count(*) AS n_steps,
        (SELECT count(DISTINCT episode_id) FROM v_steps WHERE dataset_name = 'ds_a') AS num_trajectories,
        string_agg(CAST(CAST(round((n_a0 + 1) * 100) AS INT) AS VARCHAR), ',' ORDER BY timestep) AS a0s, string_agg(image_primary, ',' ORDER BY timestep) AS images
        FROM k WHERE keep AND dataset_name = 'ds_a' GROUP BY ALL""",
        st=WIDE_STATS,
        n=f"SELECT v.*, {NORMALIZED} FROM v_steps v JOIN st USING (dataset_name)",
        k=episode_filter_sql("bool_or(language_instruction <> '')", "n"),
    ),
)
def single_dataset_frames(spark, d):
    frames, stats = single_dataset(spark, d, "ds_a")
    flat = frames.select(
        *KEYS, F.col("observation")[0]["image_primary"].alias("image"), F.round((F.col("action")[0][0] + 1) * 100).cast("int").alias("a0")
    )
    nested = E.in_parts(flat, ["image", "a0"])
    return nested.join(stats.select("dataset_name", "num_trajectories"), "dataset_name").select(
        "dataset_name",
        "episode_id",
        "part",
        F.size("steps").cast("long").alias("n_steps"),
        "num_trajectories",
        text_of(F.col("steps.a0")).alias("a0s"),
        F.array_join("steps.image", ",").alias("images"),
    )


# Images --------------------------------------------------------------------------------------------------------------

CAMERAS = {"primary": "image_primary", "wrist": "image_wrist"}


def camera_rows(spark, d):
    rows = W.step_rows(spark, d).withColumn("image_wrist", F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("image_primary")))
    return G.per_camera(rows, CAMERAS, ["event_id"])


CAMERA_SQL = """SELECT event_id, 'primary' AS camera, image_primary AS image FROM v_steps UNION ALL
  SELECT event_id, 'wrist', CASE WHEN event_id % 4 = 0 THEN '' ELSE image_primary END FROM v_steps"""


@job(
    "image_padding_plan",
    W.sql(
        "v_steps",
        """SELECT event_id, camera, image = '' AS is_padding, CASE WHEN camera = 'primary' THEN 224 WHEN image = '' THEN 1 ELSE 0 END AS out_h,
        CASE WHEN camera = 'primary' THEN 256 WHEN image = '' THEN 1 ELSE 0 END AS out_w FROM c""",
        c=CAMERA_SQL,
    ),
)
def image_padding_plan(spark, d):
    plan = G.padding_plan(camera_rows(spark, d), {"primary": (224, 256)}).drop("image")
    return plan.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("out_h", "out_w")})


def _u(op: str) -> str:
    return W.draw(31, "event_id", "camera", f"'{op}'")


@job(
    "augment_plan",
    W.sql(
        "v_steps",
        f"""SELECT event_id, camera, {sql_r6(_u('top') + ' * (1 - sqrt(0.9e0))', 'crop_top')}, {sql_r6(_u('left') + ' * (1 - sqrt(0.9e0))', 'crop_left')},
        {sql_r6('sqrt(0.9e0)', 'crop_side')}, {sql_r6('-0.2e0 + ' + _u('brightness') + ' * 0.4e0', 'brightness')}, {sql_r6('0.8e0 + ' + _u('contrast') + ' * 0.4e0', 'contrast')},
        {sql_r6('0.8e0 + ' + _u('saturation') + ' * 0.4e0', 'saturation')}, {sql_r6('-0.05e0 + ' + _u('hue') + ' * 0.1e0', 'hue')} FROM c WHERE image <> ''""",
        c=CAMERA_SQL,
    ),
)
def augment_plan(spark, d):
    plan = G.augment_plan(camera_rows(spark, d), "event_id", 31)
    return plan.select("event_id", "camera", *[r6(c).alias(c) for c in plan.columns[2:]])


@job(
    "center_crop_box",
    W.sql(
        "v_steps",
        "SELECT event_id, " + sql_wide(["(1 - s) / 2", "(1 - s) / 2", "(1 - s) / 2 + s", "(1 - s) / 2 + s"], "box") + " FROM (SELECT event_id, least(1, sqrt((event_id % 12 + 1) / 1e1)) AS s FROM v_steps)",
    ),
)
def center_crop_box(spark, d):
    box = F.array(*G.center_crop_box((F.col("event_id") % 12 + 1) / 10.0))
    return W.step_rows(spark, d).select("event_id", *wide(box, "box", 4))


@job(
    "letterbox_geometry",
    """SELECT doc_id, strategy, w, h, CAST(floor((greatest(w, h) - w) / 2) AS BIGINT) AS pad_x, CAST(floor((greatest(w, h) - h) / 2) AS BIGINT) AS pad_y,
    w + 2 * CAST(floor((greatest(w, h) - w) / 2) AS BIGINT) AS padded_w, h + 2 * CAST(floor((greatest(w, h) - h) / 2) AS BIGINT) AS padded_h,
    CAST(CASE WHEN strategy = 'resize-crop' THEN floor(224 * w / least(w, h)) ELSE 224 END AS BIGINT) AS out_w,
    CAST(CASE WHEN strategy = 'resize-crop' THEN floor(224 * h / least(w, h)) ELSE 224 END AS BIGINT) AS out_h, '123,116,103' AS fill
    FROM (SELECT doc_id, n_chars % 640 + 1 AS w, n_chars % 479 + 1 AS h, CASE doc_id % 3 WHEN 0 THEN 'resize-naive' WHEN 1 THEN 'resize-crop' ELSE 'letterbox' END AS strategy FROM documents)""",
)
def letterbox_geometry(spark, d):
    strategy = F.when(F.col("doc_id") % 3 == 0, "resize-naive").when(F.col("doc_id") % 3 == 1, "resize-crop").otherwise("letterbox")
    rows = tables.table(spark, d, "documents").select(
        "doc_id", strategy.alias("strategy"), (F.col("n_chars") % 640 + 1).alias("w"), (F.col("n_chars") % 479 + 1).alias("h")
    )
    w, h = F.col("w"), F.col("h")
    out_w, out_h = G.target_size(F.col("strategy"), w, h, 224)
    fill = F.lit(",".join(map(str, G.letterbox_fill())))
    return rows.withColumns({**G.letterbox(w, h), "out_w": out_w, "out_h": out_h, "fill": fill})


def raw_images(spark, d):
    """The bytes of every page as 8x6 raw images, one after the other; the last one is filled up with zeros."""
    size = 8 * 6 * 3
    pages = tables.table(spark, d, "pages").filter("html IS NOT NULL").select("page_id", F.encode("html", "UTF-8").alias("bytes"))
    last = F.greatest(F.ceil(F.octet_length("bytes") / size) - 1, F.lit(0)).cast("int")
    cut = pages.select("page_id", "bytes", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    piece = F.substring("bytes", F.col("part") * size + 1, F.lit(size))
    return cut.select(
        F.concat_ws("/", "page_id", "part").alias("image_id"), F.lit(8).alias("height"), F.lit(6).alias("width"),
        F.rpad(piece, size, F.lit(b"\0")).alias("data"),
    )


def pixels_sql(top: int, left: int, height: int, width: int, pad: int, fill: int, brightness: float, contrast: float) -> dict[str, str]:
    """Subqueries: the bytes inside the crop, one row each, then each value after padding, turning, brightness and contrast.

    A position is that in the result: turned by 180 degrees, the crop starts `pad` from the other corner.
    """
    across = width + 2 * pad
    border = 2 * pad * (across + height)
    lit = lambda v: f"least(1e0, greatest(0e0, {v} / 255e0 + {brightness}))"
    inside = f"y >= {top} AND y < {top + height} AND x >= {left} AND x < {left + width}"
    return {
        "raw": """SELECT page_id, part, CAST(i // 18 AS INT) AS y, CAST(i % 18 // 3 AS INT) AS x, CAST(i % 3 AS INT) AS c,
          CASE WHEN 2 * (144 * part + i) < length(h) THEN CAST('0x' || substr(h, CAST(2 * (144 * part + i) + 1 AS BIGINT), 2) AS INT) ELSE 0 END AS b
          FROM (SELECT page_id, h, unnest(range(greatest(1, CAST(ceil(length(h) / 288e0) AS BIGINT)))) AS part FROM (SELECT page_id, hex(encode(html)) AS h FROM pages WHERE html IS NOT NULL)), range(144) r(i)""",
        "bright": f"SELECT page_id, part, c, {height + pad - 1} + {top} - y AS y, {width + pad - 1} + {left} - x AS x, {lit('b')} AS v FROM raw WHERE {inside}",
        "middles": f"SELECT page_id, part, c, (sum(v) + {border} * {lit(fill)}) / {(height + 2 * pad) * across} AS m FROM bright GROUP BY ALL",
        "strong": f"SELECT page_id, part, c, y, x, least(1e0, greatest(0e0, (v - m) * {contrast} + m)) AS v FROM bright JOIN middles USING (page_id, part, c)",
        "edges": f"SELECT page_id, part, c, least(1e0, greatest(0e0, ({lit(fill)} - m) * {contrast} + m)) AS v FROM middles",
    }


PIXEL_SQL = "WITH " + ", ".join(f"{n} AS ({q})" for n, q in pixels_sql(1, 1, 6, 4, 1, 127, 0.1, 1.1).items()) + f"""
  SELECT concat_ws('/', page_id, part) AS image_id, CAST(8 AS INT) AS height, CAST(6 AS INT) AS width, CAST(144 AS INT) AS n_values,
    {', '.join(sql_r6(f"(sum(CASE WHEN s.c = {c} THEN s.v END) + 24 * max(CASE WHEN s.c = {c} THEN e.v END)) / 48 / {G.STD[c]} - {G.MEAN[c]} / {G.STD[c]}", f"mean{c}") for c in range(3))},
    {', '.join(sql_r6(f"(max(CASE WHEN s.c = {c} AND y = 2 AND x = 3 THEN s.v END) - {G.MEAN[c]}) / {G.STD[c]}", f"at{c}") for c in range(3))},
    {sql_r6(f"(max(CASE WHEN s.c = 0 THEN e.v END) - {G.MEAN[0]}) / {G.STD[0]}", "corner")}
  FROM strong s JOIN edges e USING (page_id, part, c) GROUP BY page_id, part"""


@job("pixel_batch_job", PIXEL_SQL)
def pixel_batch_job(spark, d):
    """Crop, pad, rotate, brighten and normalize; one row per image with channel means, a pixel inside and one of the border."""
    out = G.pixel_job(
        raw_images(spark, d), "image_id", crop=(1, 1, 6, 4), pad=1, fill=127, rotate=True, brightness=0.1, contrast=1.1, precision="float64"
    )

    def mean(c):
        return F.aggregate(F.filter("pixels", lambda _, i: i % 3 == c), F.lit(0.0), lambda a, v: a + v) / 48

    means = [r6(mean(c)).alias(f"mean{c}") for c in range(3)]
    inside = [r6(F.col("pixels")[(2 * 6 + 3) * 3 + c]).alias(f"at{c}") for c in range(3)]
    return out.select("image_id", "height", "width", F.size("pixels").alias("n_values"), *means, *inside, r6(F.col("pixels")[0]).alias("corner"))
