"""Step layout, sequence operators and per-dataset standardization jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.functions import rotation, text
from armature.functions import vectors as V
from armature.operators import layout as L
from armature.operators import motion
from armature.operators import standardize as S
from armature.operators.ordering import time_block
from armature.plans import views as W
from armature.plans.jobs_sources import ACTIONS, NOOP_SQL, STATES, noop_marked
from armature.plans.registry import job, r6, sql_r6, sql_wide, text_of, wide
from armature.sources import catalog, tables

KEY = "dataset_name, episode_id, timestep"
KEYS = ["dataset_name", "episode_id", "timestep"]

# Layout -------------------------------------------------------------------------------------------------------------


@job(
    "required_fields_report",
    W.sql(
        "v_steps",
        """SELECT dataset_name, count(*) AS n_rows, count(*) FILTER (language_instruction = '') AS n_no_language,
        count(*) FILTER (image_primary = '') AS n_no_image, CAST(0 AS BIGINT) AS n_wrong_length, CAST(0 AS BIGINT) AS n_not_a_number
        FROM v_steps GROUP BY 1""",
    ),
)
def required_fields(spark, d):
    return L.required_fields_report(W.step_rows(spark, d), 7, "language_instruction", "image_primary")


@job(
    "map_image_keys",
    W.sql("v_steps", "SELECT event_id, image_primary, '' AS image_secondary, image_primary AS image_wrist FROM v_steps"),
)
def map_image_keys(spark, d):
    rows = W.step_rows(spark, d).withColumnRenamed("image_primary", "camera")
    return rows.select("event_id", *L.mapped_keys("image", {"primary": "camera", "secondary": None, "wrist": "camera"}))


@job(
    "map_depth_keys",
    W.sql("v_steps", "SELECT event_id, '' AS depth_primary, image_primary AS depth_secondary FROM v_steps"),
)
def map_depth_keys(spark, d):
    rows = W.step_rows(spark, d).withColumnRenamed("image_primary", "camera")
    return rows.select("event_id", *L.mapped_keys("depth", {"primary": None, "secondary": "camera"}))


@job("concat_proprio", W.sql("v_steps", f"SELECT event_id, {sql_wide([*STATES[:6], '0e0', 's7'], 'p')} FROM v_steps"))
def concat_proprio(spark, d):
    state = F.col("state")
    return W.step_rows(spark, d).select("event_id", *wide(L.proprio([V.span(state, 0, 6), None, V.span(state, -1)]), "p", 8))


@job("add_timestep", W.sql("v_steps", f"SELECT {KEY}, event_id FROM v_steps"))
def add_timestep(spark, d):
    return W.steps(spark, d).select(*KEYS, "event_id")


@job("extract_language", W.sql("v_steps", "SELECT event_id, language_instruction AS task_language FROM v_steps"))
def extract_language(spark, d):
    rows = W.step_rows(spark, d).withColumn("task", F.struct("language_instruction")).drop("language_instruction")
    return rows.select("event_id", F.col("task.language_instruction").alias("task_language"))


def observed(df):
    """Raw layout: observation struct with image, state parts, language."""
    return df.select(
        *KEYS, "event_id", "action", "language_instruction",
        F.struct(
            F.col("image_primary").alias("image"),
            F.col("state"),
            F.col("language_instruction").alias("natural_language_instruction"),
            V.span("state", 0, 6).alias("EEF_state"),
            V.span("state", -1).alias("gripper_state"),
        ).alias("observation"),
    )


@job(
    "restructure",
    W.sql(
        "v_steps",
        f"""SELECT {KEY}, image_primary, '' AS image_wrist, timestep AS obs_timestep, language_instruction,
        {sql_wide([f'CAST(CAST(a{i} AS FLOAT) AS DOUBLE)' for i in range(7)], 'a')}, {sql_wide([f'CAST(CAST({x} AS FLOAT) AS DOUBLE)' for x in [*STATES[:6], '0e0', 's7']], 'p')} FROM v_steps""",
    ),
)
def restructure(spark, d):
    out = L.restructure(
        observed(W.steps(spark, d)), {"primary": "image", "wrist": None}, state_keys=["EEF_state", None, "gripper_state"],
        absolute_mask=[False] * 6 + [True],
    )
    return out.select(
        *KEYS,
        "observation.image_primary",
        "observation.image_wrist",
        F.col("observation.timestep").alias("obs_timestep"),
        "task.language_instruction",
        *wide(V.doubles("action"), "a", 7),
        *wide(V.doubles("observation.proprio"), "p", 8),
    )


@job(
    "absolute_action_mask",
    W.sql("v_steps", "SELECT event_id, 'false,false,false,false,false,false,true' AS mask FROM v_steps"),
)
def absolute_action_mask(spark, d):
    return L.with_absolute_mask(W.step_rows(spark, d), [False] * 6 + [True]).select(
        "event_id", text_of(F.col("absolute_action_mask")).alias("mask")
    )


@job(
    "camera_selection",
    W.sql("v_steps", "SELECT event_id, image_primary, '' AS image_wrist, '' AS depth_primary, '' AS depth_wrist FROM v_steps"),
)
def camera_selection(spark, d):
    config = catalog.datasets()["bridge_orig"]
    images, depths = L.select_cameras(config, ("primary", "wrist"), depth=True)
    rows = W.step_rows(spark, d).select("event_id", F.struct(F.col("image_primary").alias("image_0")).alias("observation"))
    return rows.select("event_id", *L.mapped_keys("image", images, "observation"), *L.mapped_keys("depth", depths, "observation"))


# stand-in corpora under catalogued names: one joint-space dataset that cannot be loaded
AS_CATALOGUED = {"ds_a": "bridge_orig", "ds_b": "berkeley_rpt_converted_externally_to_rlds", "ds_c": "droid"}


@job(
    "encoding_gate",
    W.sql(
        "v_steps",
        """SELECT CASE dataset_name WHEN 'ds_a' THEN 'bridge_orig' ELSE 'droid' END AS dataset_name, event_id, 'EEF_POS' AS action_encoding,
        'false,false,false,false,false,false,true' AS absolute_mask, 'true,true,true,true,true,true,false' AS normalization_mask
        FROM v_steps WHERE dataset_name <> 'ds_b'""",
    ),
)
def encoding_gate(spark, d):
    named = W.step_rows(spark, d)
    for short, full in AS_CATALOGUED.items():
        named = named.withColumn("dataset_name", F.when(F.col("dataset_name") == short, full).otherwise(F.col("dataset_name")))
    gated = L.encoding_gate(named, catalog.dataset_table(spark))
    return gated.select(
        "dataset_name",
        "event_id",
        "action_encoding",
        text_of(F.col("absolute_action_mask")).alias("absolute_mask"),
        text_of(F.col("action_normalization_mask")).alias("normalization_mask"),
    )


@job(
    "nested_struct_ops",
    W.sql(
        "v_steps",
        f"""SELECT event_id, {sql_r6('s0 * 2', 'doubled')}, concat('observation.image', '=', image_primary) AS keyed, language_instruction AS merged_language,
        event_id AS merged_goal, image_primary AS merged_image, '' AS padded_image, 0e0 AS padded_value FROM v_steps""",
    ),
)
def nested_struct_ops(spark, d):
    rows = W.step_rows(spark, d).select(
        "event_id",
        F.struct(F.struct(F.col("image_primary").alias("image"), F.col("state")[0].alias("value")).alias("observation")).alias("tree"),
        F.struct(F.struct(F.lit("x").alias("image"), F.lit(-1).cast("long").alias("goal")).alias("t"), "language_instruction").alias("left"),
        F.struct(F.struct(F.col("image_primary").alias("image"), F.col("event_id").alias("goal")).alias("t")).alias("right"),
    )
    s = {f.name: f.dataType for f in rows.schema.fields}

    def double_or_key(path, value, kind):
        return value * 2 if kind.simpleString() == "double" else F.concat(F.lit(".".join(path) + "="), value)

    out = rows.select(
        "event_id",
        L.map_tree(F.col("tree"), s["tree"], double_or_key).alias("mapped"),
        L.merge_trees(F.col("left"), s["left"], F.col("right"), s["right"]).alias("merged"),
        L.map_tree(F.col("tree"), s["tree"], lambda _, v, kind: L.padding_of(v, kind)).alias("padded"),
    )
    return out.select(
        "event_id",
        r6("mapped.observation.value").alias("doubled"),
        F.col("mapped.observation.image").alias("keyed"),
        F.col("merged.language_instruction").alias("merged_language"),
        F.col("merged.t.goal").alias("merged_goal"),
        F.col("merged.t.image").alias("merged_image"),
        F.col("padded.observation.image").alias("padded_image"),
        F.col("padded.observation.value").alias("padded_value"),
    )


@job(
    "env_proprio_pad",
    W.sql(
        "v_steps",
        "SELECT event_id, event_id % 9 = 0 AS truncated, "
        + sql_wide([f"CASE WHEN event_id % 9 = 0 THEN 0e0 ELSE {x} END" for x in [*STATES[:6], "0e0", "s7"]], "p")
        + " FROM v_steps",
    ),
)
def env_proprio_pad(spark, d):
    reading = F.when(F.col("event_id") % 9 != 0, F.col("state"))
    padded = F.concat(V.span(reading, 0, 6), V.zeros(1), V.span(reading, -1))
    return W.step_rows(spark, d).select(
        "event_id", reading.isNull().alias("truncated"), *wide(F.coalesce(padded, V.zeros(8)), "p", 8)
    )


# Sequence and vector operators ---------------------------------------------------------------------------------------

BINARY_SQL = """SELECT *, coalesce(
    first_value(CASE WHEN a6 > 0.95 THEN 1e0 WHEN a6 < 0.05 THEN 0e0 END IGNORE NULLS) OVER (PARTITION BY {p} ORDER BY timestep ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(a6) OVER (PARTITION BY {p} ORDER BY timestep ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS gripper FROM {t}"""
MOTION = "CASE WHEN grip_rel < -0.1 THEN 1e0 WHEN grip_rel > 0.1 THEN -1e0 END"
RELATIVE_SQL = f"""SELECT *, coalesce(
    last_value({MOTION} IGNORE NULLS) OVER (PARTITION BY episode_id ORDER BY timestep ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    -first_value({MOTION} IGNORE NULLS) OVER (PARTITION BY episode_id ORDER BY timestep ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 1e0) / 2e0 + 5e-1 AS gripper FROM v_steps"""


@job(
    "binarize_gripper",
    W.sql("v_short", "SELECT dataset_name, episode_id, CAST(day AS VARCHAR) AS day, timestep, gripper FROM b", b=BINARY_SQL.format(p="episode_id, day", t="v_short")),
)
def binarize_gripper(spark, d):
    keys = ["dataset_name", "episode_id", "day"]
    out = motion.binarize_gripper(W.short_steps(spark, d), F.col("action")[6], keys=keys)
    return out.select("dataset_name", "episode_id", F.col("day").cast("string").alias("day"), "timestep", "gripper")


@job("invert_gripper", W.sql("v_steps", f"SELECT event_id, {sql_r6('1 - a6', 'gripper')} FROM v_steps"))
def invert_gripper(spark, d):
    return W.step_rows(spark, d).select("event_id", r6(A.invert_gripper(F.col("action")[6])).alias("gripper"))


@job("rel_to_abs_gripper", W.sql("v_steps", f"SELECT {KEY}, gripper FROM r", r=RELATIVE_SQL))
def rel_to_abs_gripper(spark, d):
    return motion.absolute_gripper(W.steps(spark, d), F.col("grip_rel")).select(*KEYS, "gripper")


@job("clip_gripper", W.sql("v_steps", f"SELECT event_id, {sql_r6('greatest(0e0, least(1e0, a4))', 'gripper')} FROM v_steps"))
def clip_gripper(spark, d):
    return W.step_rows(spark, d).select("event_id", r6(A.clip_gripper(F.col("action")[4])).alias("gripper"))


REACHED_SQL = "SELECT *, " + ", ".join(f"lead(s{i}) OVER (PARTITION BY episode_id ORDER BY timestep) - s{i} AS m{i}" for i in range(6)) + " FROM {t}"


@job(
    "relabel_by_reached_state",
    W.sql("v_steps", f"SELECT {KEY}, {sql_wide([f'm{i}' for i in range(6)] + ['a6'], 'a')} FROM m WHERE m0 IS NOT NULL", m=REACHED_SQL.format(t="v_steps")),
)
def relabel(spark, d):
    return motion.relabel_by_reached_state(W.steps(spark, d), F.col("state")).select(*KEYS, *wide("action", "a", 7))


@job(
    "drop_first_step",
    W.sql("v_short", "SELECT dataset_name, episode_id, CAST(day AS VARCHAR) AS day, CAST(timestep - 1 AS INT) AS timestep, event_id FROM v_short WHERE timestep > 0"),
)
def drop_first_step(spark, d):
    return motion.drop_first_step(W.short_steps(spark, d)).select(
        "dataset_name", "episode_id", F.col("day").cast("string").alias("day"), "timestep", "event_id"
    )


@job(
    "vector_slice_concat",
    "SELECT vec_id, "
    + sql_wide([f"CAST(embedding[{i}] AS DOUBLE)" for i in (1, 2, 3)] + ["0e0"] * 3 + ["CAST(embedding[64] AS DOUBLE)", "1e0"], "v")
    + ", "
    + sql_wide([f"CAST(embedding[{i}] AS DOUBLE)" for i in range(57, 63)], "w")
    + " FROM embeddings",
)
def vector_slice_concat(spark, d):
    e = V.doubles("embedding")
    v = F.concat(V.span(e, 0, 3), V.zeros(3), F.array(V.at(e, -1)), V.ones(1))
    return tables.table(spark, d, "embeddings").select("vec_id", *wide(v, "v", 8), *wide(V.span(e, -8, -2), "w", 6))


def quaternions(spark, d):
    """Unit quaternions from vector elements 3..6."""
    q = [F.col("e")[i] for i in range(3, 7)]
    n = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3])
    rows = tables.table(spark, d, "embeddings").select("vec_id", V.doubles("embedding").alias("e"))
    return rows.withColumn("q", F.array(*[x / n for x in q]))


QUAT_SQL = """SELECT vec_id, embedding, x / n AS x, y / n AS y, z / n AS z, w / n AS w FROM (SELECT *, sqrt(x * x + y * y + z * z + w * w) AS n FROM
 (SELECT vec_id, embedding, CAST(embedding[4] AS DOUBLE) AS x, CAST(embedding[5] AS DOUBLE) AS y, CAST(embedding[6] AS DOUBLE) AS z, CAST(embedding[7] AS DOUBLE) AS w FROM embeddings))"""
EULER = [
    "atan2(2 * (y * z + x * w), 1 - 2 * (x * x + y * y))",
    "-asin(greatest(-1, least(1, 2 * (x * z - y * w))))",
    "atan2(2 * (x * y + z * w), 1 - 2 * (y * y + z * z))",
]


@job("quaternion_to_euler", f"WITH q AS ({QUAT_SQL}) SELECT vec_id, {sql_wide(EULER, 'angle')} FROM q")
def quaternion_to_euler(spark, d):
    q = F.col("q")
    return quaternions(spark, d).select("vec_id", *wide(F.array(*rotation.quaternion_to_euler(q[0], q[1], q[2], q[3])), "angle", 3))


def _matrix_sql(r: str, p: str, y: str) -> list[list[str]]:
    return [
        [f"cos({p})*cos({y})", f"(sin({r})*sin({p})*cos({y}) - cos({r})*sin({y}))", f"(cos({r})*sin({p})*cos({y}) + sin({r})*sin({y}))"],
        [f"cos({p})*sin({y})", f"(sin({r})*sin({p})*sin({y}) + cos({r})*cos({y}))", f"(cos({r})*sin({p})*sin({y}) - sin({r})*cos({y}))"],
        [f"(-sin({p}))", f"sin({r})*cos({p})", f"cos({r})*cos({p})"],
    ]


def _wrist_ctes(source: str, v: list[str], angles: list[str]) -> dict[str, str]:
    """Named matrix entries: f = wrist frame, g = rotation part of the velocity; then products entry by entry."""
    f, g = _matrix_sql(*angles), _matrix_sql(*v[3:6])
    cells = ", ".join(f"{m[r][c]} AS {n}{r}{c}" for n, m in (("f", f), ("g", g)) for r in range(3) for c in range(3))
    inner = ", ".join(" + ".join(f"g{r}{k}*f{k}{c}" for k in range(3)) + f" AS h{r}{c}" for r in range(3) for c in range(3))
    lin = ", ".join(" + ".join(f"f{k}{r}*({v[k]})" for k in range(3)) + f" AS w{r}" for r in range(3))
    rot = ", ".join(" + ".join(f"f{k}{r}*h{k}{c}" for k in range(3)) + f" AS w{3 + 3 * r + c}" for r in range(2) for c in range(3))
    return {
        "cells": f"SELECT *, {cells} FROM {source}",
        "inner_product": f"SELECT *, {inner}, {lin} FROM cells",
        "wrist": f"SELECT *, {rot} FROM inner_product",
    }


def _with(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes.items()) + "\n" + body


E_SQL = [f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(12)]


@job(
    "velocity_to_wrist_frame",
    _with(
        {"e": "SELECT vec_id, " + ", ".join(f"{x} AS e{i}" for i, x in enumerate(E_SQL)) + " FROM embeddings", **_wrist_ctes("e", [f"e{i}" for i in range(6)], ["e9", "e10", "e11"])},
        f"SELECT vec_id, {sql_wide([f'w{i}' for i in range(9)], 'w')} FROM wrist",
    ),
)
def velocity_to_wrist_frame(spark, d):
    e = F.col("e")
    rows = tables.table(spark, d, "embeddings").select("vec_id", V.doubles("embedding").alias("e"))
    out = rotation.velocity_in_wrist_frame([e[i] for i in range(6)], [e[i] for i in range(9, 12)])
    return rows.select("vec_id", *wide(F.array(*out), "w", 9))


def droid_raw(spark, d):
    rows = W.steps(spark, d)
    image = F.col("image_primary")
    return rows.select(
        *KEYS, "language_instruction",
        F.struct(V.span("action", 0, 6).alias("cartesian_velocity"), V.span("action", 6).alias("gripper_position")).alias("action_dict"),
        F.struct(
            F.concat(F.lit("L"), image).alias("exterior_image_1_left"),
            F.concat(F.lit("R"), image).alias("exterior_image_2_left"),
            V.each(V.span("state", 0, 6), 6, lambda x, _: x / 10.0).alias("cartesian_position"),
            V.span("state", 7).alias("gripper_position"),
        ).alias("observation"),
    )


WRIST = _wrist_ctes("v_steps", ACTIONS[:6], ["s3 / 1e1", "s4 / 1e1", "s5 / 1e1"])


@job(
    "wrist_action_standardize",
    W.sql(
        "v_steps",
        f"SELECT {KEY}, {sql_wide([f'w{i}' for i in range(9)] + ['a6'], 'a')}, {sql_wide([f's{i} / 1e1' for i in range(6)] + ['s7'], 'p')} FROM wrist",
        **WRIST,
    ),
)
def wrist_action_standardize(spark, d):
    out = S.apply_recipe(droid_raw(spark, d), S.LAYOUTS["droid_wrist"], 5)
    return out.select(*KEYS, *wide("action", "a", 10), *wide("observation.proprio", "p", 7))


@job(
    "swap_exterior_images",
    W.sql(
        "v_steps",
        f"""SELECT event_id, CASE WHEN {W.draw(5, 'dataset_name', 'episode_id')} > 0.5 THEN 'L' ELSE 'R' END || image_primary AS image_1,
        CASE WHEN {W.draw(5, 'dataset_name', 'episode_id')} > 0.5 THEN 'R' ELSE 'L' END || image_primary AS image_2 FROM v_steps""",
    ),
)
def swap_exterior_images(spark, d):
    image = F.col("image_primary")
    rows = W.step_rows(spark, d).withColumns({"image_1": F.concat(F.lit("L"), image), "image_2": F.concat(F.lit("R"), image)})
    return S.swap_exterior_images(rows, "image_1", "image_2", 5).select("event_id", "image_1", "image_2")


@job("decode_codepoint_language", "SELECT doc_id, text FROM documents")
def decode_codepoint_language(spark, d):
    """Encode every text as padded code points, then decode it again."""
    points = F.transform(F.split("text", ""), lambda c: F.ascii(c))
    padded = F.concat(points, F.array_repeat(F.lit(0), 3))
    rows = tables.table(spark, d, "documents").select("doc_id", padded.alias("cp"))
    return rows.select("doc_id", text.from_code_points(F.col("cp")).alias("text"))


@job("gripper_from_observation", W.sql("v_steps", f"SELECT event_id, {sql_wide([*ACTIONS[:6], '1 - s6'], 'a')} FROM v_steps"))
def gripper_from_observation(spark, d):
    rows = W.step_rows(spark, d)
    action = F.concat(V.span("action", 0, 6), F.array(A.invert_gripper(F.col("state")[6])))
    return rows.select("event_id", *wide(action, "a", 7))


@job(
    "quat_to_axis_angle",
    f"""WITH q AS ({QUAT_SQL}) SELECT vec_id, {sql_wide([f'CASE WHEN 1 - w * w <= 0 THEN 0e0 ELSE {v} * 2 * acos(greatest(-1, least(1, w))) / sqrt(1 - w * w) END' for v in 'xyz'], 'r')} FROM q""",
)
def quat_to_axis_angle(spark, d):
    q = F.col("q")
    return quaternions(spark, d).select("vec_id", *wide(F.array(*rotation.quaternion_to_axis_angle(q[0], q[1], q[2], q[3])), "r", 3))


@job(
    "env_gripper_rescale",
    W.sql("v_steps", f"SELECT event_id, {sql_r6('2 * a6 - 1', 'scaled')}, {sql_r6('-sign(2 * a6 - 1)', 'flipped')} FROM v_steps"),
)
def env_gripper_rescale(spark, d):
    g = F.col("action")[6]
    return W.step_rows(spark, d).select(
        "event_id", r6(A.environment_gripper(g, binarize=False)).alias("scaled"), r6(A.environment_gripper(g, flip=True)).alias("flipped")
    )


@job("noop_filter", W.sql("v_noop", f"SELECT {KEY}, is_noop FROM m", m=NOOP_SQL))
def noop_filter(spark, d):
    return noop_marked(spark, d).select(*KEYS, "is_noop")


# Standardization ----------------------------------------------------------------------------------------------------

BRIDGE_CTES = {
    "dropped": "SELECT * REPLACE (CAST(timestep - 1 AS INT) AS timestep) FROM v_steps WHERE timestep > 0",
    "b": BINARY_SQL.format(p="episode_id", t="dropped"),
    "m": REACHED_SQL.format(t="b"),
}


def bridge(spark, d):
    return S.standardize(observed(W.steps(spark, d)), "bridge_orig")


@job(
    "standardize_bridge_family",
    W.sql("v_steps", f"SELECT {KEY}, {sql_wide([f'm{i}' for i in range(6)] + ['gripper'], 'a')}, {sql_wide(STATES[:6], 'e')} FROM m WHERE m0 IS NOT NULL", **BRIDGE_CTES),
)
def standardize_bridge_family(spark, d):
    return bridge(spark, d).select(*KEYS, *wide("action", "a", 7), *wide("observation.EEF_state", "e", 6))


def relative_raw(spark, d):
    return W.steps(spark, d).select(
        *KEYS, "language_instruction",
        F.struct(
            V.span("action", 0, 3).alias("world_vector"),
            V.span("action", 3, 6).alias("rotation_delta"),
            F.array("grip_rel").alias("gripper_closedness_action"),
        ).alias("action"),
        F.struct(
            F.col("image_primary").alias("image"),
            F.col("language_instruction").alias("natural_language_instruction"),
            F.col("state").alias("end_effector_cartesian_pos"),
        ).alias("observation"),
    )


@job(
    "standardize_rel_gripper_family",
    W.sql(
        "v_steps",
        f"""SELECT 'rt1' AS layout, {KEY}, language_instruction, {sql_wide([*ACTIONS[:6], 'gripper'], 'a')} FROM r
        UNION ALL SELECT 'jaco', {KEY}, language_instruction, {sql_wide([*ACTIONS[:3], '0e0', '0e0', '0e0', 'gripper'], 'a')} FROM r""",
        r=RELATIVE_SQL,
    ),
)
def standardize_rel_gripper_family(spark, d):
    raw = relative_raw(spark, d)
    pick = lambda df, n: df.select(F.lit(n).alias("layout"), *KEYS, "language_instruction", *wide("action", "a", 7))
    return pick(S.standardize(raw, "fractal20220817_data"), "rt1").unionByName(pick(S.standardize(raw, "jaco_play"), "jaco"))


def stacked(spark, rows, layouts, width):
    """The same raw rows under several dataset recipes."""
    out = None
    for name, dataset in layouts.items():
        part = S.standardize(rows, dataset).select(F.lit(name).alias("layout"), "event_id", *wide("action", "a", width))
        out = part if out is None else out.unionByName(part)
    return out


def stacked_sql(forms: dict[str, list[str]], table: str = "v_steps", key: str = "event_id") -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS layout, {key}, {sql_wide(f, 'a')} FROM {table}" for n, f in forms.items())


CLIP4 = "greatest(0e0, least(1e0, a6))"


@job(
    "standardize_abs_gripper_family",
    W.sql(
        "v_steps",
        stacked_sql(
            {
                "libero": [*ACTIONS[:6], f"1 - {CLIP4}"],
                "hydra": [*ACTIONS[:6], "1 - a6"],
                "buds": [*ACTIONS[:6], f"1 - {CLIP4}"],
                "edan": [*ACTIONS[:6], "1 - a6"],
            }
        ),
    ),
)
def standardize_abs_gripper_family(spark, d):
    rows = W.step_rows(spark, d).withColumn("observation", F.struct(F.concat(F.col("state"), V.zeros(2)).alias("state")))
    return stacked(
        spark, rows,
        {
            "libero": "libero_10_no_noops",
            "hydra": "stanford_hydra_dataset_converted_externally_to_rlds",
            "buds": "austin_buds_dataset_converted_externally_to_rlds",
            "edan": "dlr_edan_shared_control_converted_externally_to_rlds",
        },
        7,
    )


@job(
    "standardize_pad_or_trim_family",
    W.sql(
        "v_steps",
        stacked_sql(
            {
                "robo_net": [*ACTIONS[:4], "0e0", "0e0", "a6"],
                "kaist": [*ACTIONS[:6], "0e0"],
                "pick_place": [*ACTIONS[:3], "0e0", "0e0", "0e0", "a6"],
                "play_fusion": [*ACTIONS[:3], *ACTIONS[3:]],
                "bimanual": ACTIONS,
            }
        ),
    ),
)
def standardize_pad_or_trim_family(spark, d):
    rows = W.step_rows(spark, d).withColumn("observation", F.struct("state"))
    return stacked(
        spark, rows,
        {
            "robo_net": "robo_net",
            "kaist": "kaist_nonprehensile_converted_externally_to_rlds",
            "pick_place": "ucsd_pick_and_place_dataset_converted_externally_to_rlds",
            "play_fusion": "cmu_play_fusion",
            "bimanual": "utokyo_xarm_bimanual_converted_externally_to_rlds",
        },
        7,
    )


@job(
    "standardize_rotation_family",
    f"WITH q AS ({QUAT_SQL}) "
    + stacked_sql(
        {
            "furniture": [*E_SQL[:3], *EULER, f"1 - greatest(0, least(1, {E_SQL[7]}))"],
            "iamlab": [*E_SQL[:3], *EULER, E_SQL[7]],
            "food": [*E_SQL[:3], *EULER, E_SQL[7]],
        },
        "q",
        "vec_id AS event_id",
    ),
)
def standardize_rotation_family(spark, d):
    rows = quaternions(spark, d).select(
        F.col("vec_id").alias("event_id"),
        F.concat(V.span("e", 0, 3), F.col("q"), V.span("e", 7, 8)).alias("action"),
        F.struct(V.span("e", 0, 8).alias("state")).alias("observation"),
    )
    return stacked(
        spark, rows,
        {
            "furniture": "furniture_bench_dataset_converted_externally_to_rlds",
            "iamlab": "iamlab_cmu_pickup_insert_converted_externally_to_rlds",
            "food": "cmu_playing_with_food",
        },
        7,
    )


@job(
    "standardize_state_only_family",
    W.sql(
        "v_steps",
        f"""SELECT 'lsmo' AS layout, event_id, {sql_wide(STATES[:6], 'e')}, {sql_r6('s7', 'g')} FROM v_steps
        UNION ALL SELECT 'fanuc', event_id, {sql_wide(STATES[:6], 'e')}, {sql_r6('s6', 'g')} FROM v_steps""",
    ),
)
def standardize_state_only_family(spark, d):
    rows = W.step_rows(spark, d).withColumn("observation", F.struct("state"))
    lsmo = S.standardize(rows, "tokyo_u_lsmo_converted_externally_to_rlds")
    fanuc = S.standardize(rows, "berkeley_fanuc_manipulation")
    g = r6(F.col("observation.gripper_state")[0]).alias("g")
    a = lsmo.select(F.lit("lsmo").alias("layout"), "event_id", *wide("observation.eef_state", "e", 6), g)
    b = fanuc.select(F.lit("fanuc").alias("layout"), "event_id", *wide("observation.joint_state", "e", 6), g)
    return a.unionByName(b)


# Every registered dataset in one table: an episode belongs to dataset number (user modulo 73), in registry order.
NAMES = list(S.registry())
#: Raw fields of a step, as elements of the view's action (a0..a6) and state (s0..s7), `g` for the relative gripper command and q0..q3
#: for a unit quaternion. Fields that are not listed are the whole state, and `action` is a0..a6 unless a layout says otherwise.
RAW_FIELDS = {
    "action": "a0 a1 a2 a3 a4 a5 a6", "action.world_vector": "a0 a1 a2", "action.rotation_delta": "a3 a4 a5", "action.open_gripper": "a6", "action.gripper_closedness_action": "g",
    "action.rel_actions_world": "a0 a1 a2 a3 a4 a5 a6", "action.future/xyz_residual": "a0 a1 a2 s0", "action.future/axis_angle_residual": "a3 a4 a5 s1", "action.future/target_close": "a6",
    "action_dict.cartesian_velocity": "a0 a1 a2 a3 a4 a5", "action_dict.gripper_position": "a6", "action.tcp_base": "a0 a1 a2 a3 a4 a5", "action.gripper": "a6",
}
LONG, TURNED = "a0 a1 a2 a3 a4 a5 a6 s0", "a0 a1 a2 q0 q1 q2 q3 a6"
RAW_ACTIONS = {"language_table": "a0 a1", "gnm": "a0 a1", "d3field": "a0 a1 a2", "fanuc": "a0 a1 a2 a3 a4 a5"}
RAW_ACTIONS |= dict.fromkeys(["without_last", "joints_without_last", "eef_without_last", "stretch", "franka_play", "roboset"], LONG) | dict.fromkeys(["furniture", "iamlab", "food"], TURNED)
# what each layout makes of them, in SQL; the others leave a0..a6 as they are
MOVED, CLIPPED, GRASP = "a0 a1 a2 a3 a4 a5", "greatest(0e0,least(1e0,a6))", "greatest(0e0,least(1e0,grip_rel))"
SHORT, TURN = "a0 a1 a2 0e0 0e0 0e0", "a0 a1 a2 e0 e1 e2"
MADE = {
    "bridge_split": "m0 m1 m2 m3 m4 m5 a6", "bridge": "m0 m1 m2 m3 m4 m5 settled", "teleop": f"{MOVED} settled", "relative": f"{MOVED} commanded", "taco": f"{MOVED} {CLIPPED}",
    "jaco": f"{SHORT} commanded", "cable": f"{MOVED} 0e0", "roboturk": f"{MOVED} 1-{GRASP}", "viola": f"{MOVED} 1-{GRASP}", "autolab": f"{MOVED} commanded",
    "language_table": "a0 a1 0e0 0e0 0e0 0e0 1e0", "pusht": f"{MOVED} grip_rel", "kuka_multimodal": f"{SHORT} a6", "hydra": f"{MOVED} 1-a6", "state8": f"{MOVED} 1-{CLIPPED}",
    "franka_play": f"{MOVED} {CLIPPED}", "furniture": f"{TURN} 1-{CLIPPED}", "pick_place": f"{SHORT} a6", "clipped_flipped": f"{MOVED} 1-{CLIPPED}", "bc_z": f"{MOVED} 1-a6",
    "robo_net": "a0 a1 a2 a3 0e0 0e0 a6", "kaist": f"{MOVED} 0e0", "mask_vit": "a0 a1 a2 a3 0e0 0e0 a6", "flipped": f"{MOVED} 1-a6", "iamlab": f"{TURN} a6",
    "d3field": "a0 a1 a2 0e0 0e0 0e0 0e0", "fanuc": f"{MOVED} 1-s6", "food": f"{TURN} a6", "gnm": "a0 a1 0e0 0e0 0e0 0e0 0e0", "droid": f"{MOVED} 1-a6",
    "droid_single": f"{MOVED} 1-a6", "roboset": f"{MOVED} a6 1-greatest(0e0,least(1e0,s0))", "libero": f"{MOVED} 1-{CLIPPED}",
}
# observation fields checked: the first numbers of the first field of each layout, where it has one
FIELD = {
    "bridge_split": "s0 s1", "bridge": "s0 s1", "teleop": "s0 s1", "taco": "s0 s1", "jaco": "s0 s1", "autolab": "s6 s7", "nyu_rot": "s0 s1", "hydra": "s0 s1", "state8": "s0 s1",
    "franka_play": "s2 s3", "maniskill": "s7 NULL", "furniture": "s0 s1", "joints_without_last": "s0 s1", "pick_place": "s0 s1", "eef_without_last": "s0 s1", "robo_net": "s0 s1", "kaist": "s1 s2",
    "mask_vit": "s0 s1", "eef_only": "s0 s1", "state6": "s0 s1", "asu": "s0 s1", "iamlab": "s0 s1", "fanuc": "s0 s1", "stretch": "s0 s1", "gnm": "s0 s1", "droid": "s0 s1", "droid_single": "s0 s1",
    "fmb": "s0 s1", "dobbe": "s0 s1", "roboset": "s0 s1", "rh20t": "s0 s1", "libero": "s0 s1",
}
LAYOUT_OF = [next(n for n, r in S.LAYOUTS.items() if r is S.registry()[name]) for name in NAMES]


def chosen_sql(made: dict[str, str], i: int, default: str) -> str:
    """CASE over the layouts: expression i of each."""
    ways = {}
    for layout, row in made.items():
        parts = row.split()
        if layout in LAYOUT_OF and i < len(parts) and parts[i] != default:
            ways.setdefault(parts[i], []).append(layout)
    cases = " ".join(f"WHEN layout IN ({', '.join(repr(x) for x in of)}) THEN {e}" for e, of in ways.items())
    return f"CASE {cases} ELSE {default} END" if cases else default


MIXED_VALUES = ", ".join(
    [
        *[sql_r6(chosen_sql(MADE, i, f"a{i}" if i < 7 else "NULL"), f"a{i}") for i in range(8)],
        *[sql_r6(chosen_sql(FIELD, i, "NULL"), f"f{i}") for i in range(2)],
    ]
)
MIXED_SQL = {
    "named": f"SELECT *, [{', '.join(repr(n) for n in NAMES)}][CAST(episode_id % 73 AS INT) + 1] AS dataset, [{', '.join(repr(n) for n in LAYOUT_OF)}][CAST(episode_id % 73 AS INT) + 1] AS layout, 0.6e0 * sin(a1) AS x, 0.8e0 * sin(a1) AS y, 0e0 AS z, cos(a1) AS w FROM v_steps",
    "turned": f"SELECT *, {', '.join(f'{e} AS e{i}' for i, e in enumerate(EULER))} FROM named",
    "b": BINARY_SQL.format(p="episode_id", t="turned").replace(" AS gripper", " AS settled"),
    "r": RELATIVE_SQL.replace("FROM v_steps", "FROM b").replace(" AS gripper", " AS commanded"),
    "m": REACHED_SQL.format(t="r"),
}


def mixed_steps(spark, d):
    """All steps in the common slots; which field stands in a slot depends on the dataset of the row."""
    rows = W.step_rows(spark, d)
    turn = F.col("action")[1]
    value = {f"a{i}": F.col("action")[i] for i in range(7)} | {f"s{i}": F.col("state")[i] for i in range(8)} | {"g": F.col("grip_rel")}
    value |= {"q0": 0.6 * F.sin(turn), "q1": 0.8 * F.sin(turn), "q2": F.lit(0.0), "q3": F.cos(turn)}
    slots: dict[str, dict[str, list[str]]] = {}  # slot -> elements -> layouts
    for layout in dict.fromkeys(LAYOUT_OF):
        for path, slot in S.slots_of(S.LAYOUTS[layout]).items():
            made = RAW_ACTIONS.get(layout, RAW_FIELDS["action"]) if path == "action" else RAW_FIELDS.get(path, "s0 s1 s2 s3 s4 s5 s6 s7")
            slots.setdefault(slot, {}).setdefault(made, []).append(layout)
    number = F.col("episode_id") % len(NAMES)
    nth = lambda names: F.element_at(F.split(F.lit(",".join(names)), ","), (number + 1).cast("int"))
    named = rows.select(nth(NAMES).alias("dataset_name"), nth(LAYOUT_OF).alias("layout"), "episode_id", "ts", "event_id", "language_instruction", "action", "state", "grip_rel")
    columns = []
    for i in range(S.slot_count()):
        found = None
        for made, of in slots[f"slot{i}"].items():
            way = F.expr(f"layout IN ({', '.join(repr(x) for x in of)})"), F.array(*[value[e] for e in made.split()])
            found = F.when(*way) if found is None else found.when(*way)
        columns.append(found.alias(f"slot{i}"))
    return named.select("dataset_name", "episode_id", "ts", "event_id", "language_instruction", F.col("language_instruction").alias("slot_text"), *columns)


@job(
    "standardize_dispatch",
    W.sql("v_steps", f"SELECT dataset AS dataset_name, episode_id, CAST(timestep - CASE WHEN layout LIKE 'bridge%' THEN 1 ELSE 0 END AS INT) AS timestep, language_instruction, {MIXED_VALUES} FROM m WHERE layout NOT LIKE 'bridge%' OR (timestep > 0 AND m0 IS NOT NULL)", **MIXED_SQL),
)
def standardize_dispatch(spark, d):
    out = S.standardize_mixed(mixed_steps(spark, d), order=["ts", "event_id"], block=time_block(F.col("ts")))
    field = F.get(F.map_values("observation"), F.lit(0))
    return out.select(*KEYS, "language_instruction", *[r6(F.get("action", F.lit(i))).alias(f"a{i}") for i in range(8)], *[r6(F.get(field, F.lit(i))).alias(f"f{i}") for i in range(2)])
