"""Every registered dataset against formulas written out in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from armature.operators import episodes as E
from armature.operators import standardize as S
from armature.sources import catalog

T_LEN = 6
RNG = np.random.default_rng(11)


def noise(*shape):
    return RNG.uniform(-1.5, 1.5, size=shape).round(3)


def clip(x):
    return np.clip(x, 0, 1)


def binary(x):
    out, carry = [], x[-1]
    for v in x[::-1]:
        carry = 1.0 if v > 0.95 else 0.0 if v < 0.05 else carry
        out.append(carry)
    return np.array(out[::-1])[:, None]


def absolute(x):
    m = np.where(x < -0.1, 1.0, np.where(x > 0.1, -1.0, 0.0))
    carry = -m[np.argmax(m != 0)] or 1.0
    out = []
    for v in m:
        carry = v or carry
        out.append(carry / 2 + 0.5)
    return np.array(out)[:, None]


def reached(action, state):
    return np.hstack([state[1:, :6] - state[:-1, :6], action[:-1, -1:]])


def zeros(n):
    return np.zeros((T_LEN, n))


SPLIT = dict(world_vector=noise(T_LEN, 3), rotation_delta=noise(T_LEN, 3))
BASE = np.hstack([SPLIT["world_vector"], SPLIT["rotation_delta"]])
CLOSE1, OPEN = noise(T_LEN, 1), noise(T_LEN)
ARM, STATE = noise(T_LEN, 8), noise(T_LEN, 10)
LAST = ARM[:, -1:]
DROID = dict(cartesian_velocity=noise(T_LEN, 6), gripper_position=noise(T_LEN, 1))
POSE, POSE_GRIP = noise(T_LEN, 6), noise(T_LEN, 1)
XY = noise(T_LEN, 2)

split = dict(action=SPLIT | {"gripper_closedness_action": CLOSE1})
scalar = dict(action=SPLIT | {"gripper_closedness_action": OPEN})
opened = dict(action=SPLIT | {"open_gripper": OPEN})
arm = dict(action=ARM, observation={"state": STATE})
arm7 = dict(action=ARM[:, 1:], observation={"state": STATE})
flip = np.hstack([ARM[:, :6], 1 - clip(LAST)])
teleop = dict(action=ARM[:, 1:], observation={"cartesian_position": POSE, "gripper_position": POSE_GRIP})
TELEOP = (np.hstack([ARM[:, 1:7], binary(ARM[:, -1])]), {"EEF_state": POSE, "gripper_state": POSE_GRIP})
EEF = {"eef_state": STATE[:, :6], "gripper_state": STATE[:, -1:]}
LIBERO = (np.hstack([ARM[:, 1:7], 1 - clip(LAST)]), {"EEF_state": STATE[:, :6], "gripper_state": STATE[:, -2:]})
BRIDGE7 = ARM[:, 1:]
DROID_RAW = dict(
    action_dict=DROID,
    observation={"cartesian_position": POSE, "gripper_position": POSE_GRIP, "exterior_image_1_left": ["l"] * T_LEN, "exterior_image_2_left": ["r"] * T_LEN},
)
DROID_OUT = (np.hstack([DROID["cartesian_velocity"], 1 - DROID["gripper_position"]]), {"proprio": np.hstack([POSE, POSE_GRIP])})
FOUR = np.hstack([ARM[:, :4], zeros(2), LAST])

# dataset -> (raw layout, expected action or None when unchanged, expected observation fields)
CASES = {
    "bridge_oxe": (opened | {"observation": {"state": STATE}}, reached(np.hstack([BASE, OPEN[:, None]])[1:], STATE[1:]), {"EEF_state": STATE[1:-1, :6]}),
    "bridge_orig": (dict(action=BRIDGE7, observation={"state": STATE}), reached(np.hstack([BRIDGE7[1:, :6], binary(BRIDGE7[1:, -1])]), STATE[1:]), {"gripper_state": STATE[1:-1, -1:]}),
    "ppgm": (teleop, *TELEOP),
    "tdroid_flip_pot_upright": (teleop, *TELEOP),
    "fractal20220817_data": (split, np.hstack([BASE, absolute(CLOSE1[:, 0])]), {}),
    "kuka": (split, np.hstack([BASE, absolute(CLOSE1[:, 0])]), {}),
    "nyu_door_opening_surprising_effectiveness": (split, np.hstack([BASE, absolute(CLOSE1[:, 0])]), {}),
    "taco_play": (dict(action={"rel_actions_world": BRIDGE7}, observation={"robot_obs": STATE}), np.hstack([BRIDGE7[:, :6], clip(BRIDGE7[:, -1:])]), {"state_gripper": STATE[:, 7:8]}),
    "jaco_play": (split | {"observation": {"end_effector_cartesian_pos": STATE}}, np.hstack([SPLIT["world_vector"], zeros(3), absolute(CLOSE1[:, 0])]), {"state_eef": STATE[:, :6]}),
    "berkeley_cable_routing": (dict(action=SPLIT), np.hstack([BASE, zeros(1)]), {}),
    "roboturk": (split, np.hstack([BASE, 1 - clip(CLOSE1)]), {}),
    "viola": (scalar, np.hstack([BASE, 1 - clip(OPEN[:, None])]), {}),
    "berkeley_autolab_ur5": (scalar | {"observation": {"robot_state": noise(T_LEN, 15), "image_with_depth": ["d"] * T_LEN}}, np.hstack([BASE, absolute(OPEN)]), {}),
    "toto": (opened, np.hstack([BASE, OPEN[:, None]]), {}),
    "language_table": (dict(action=XY, observation={"instruction": [[104, 105, 0, 0]] * T_LEN}), np.hstack([XY, zeros(4), zeros(1) + 1]), {}),
    "columbia_cairlab_pusht_real": (scalar, np.hstack([BASE, OPEN[:, None]]), {}),
    "stanford_kuka_multimodal_dataset_converted_externally_to_rlds": (dict(action=ARM, observation={"depth_image": [[[1.0, 2.0], [3.0, 4.0]]] * T_LEN}), np.hstack([ARM[:, :3], zeros(3), LAST]), {"depth_image": [[1.0, 3.0]] * T_LEN}),
    "nyu_rot_dataset_converted_externally_to_rlds": (arm, ARM[:, :7], EEF),
    "stanford_hydra_dataset_converted_externally_to_rlds": (arm, np.hstack([ARM[:, :6], 1 - LAST]), {"eef_state": np.hstack([STATE[:, :3], STATE[:, 7:10]]), "gripper_state": STATE[:, -3:-2]}),
    "austin_buds_dataset_converted_externally_to_rlds": (arm, flip, {"state": STATE[:, :8]}),
    "utaustin_mutex": (arm, flip, {"state": STATE[:, :8]}),
    "nyu_franka_play_dataset_converted_externally_to_rlds": (dict(action=STATE, observation={"state": STATE, "depth": [[[1.0]]] * T_LEN, "depth_additional_view": [[[2.0]]] * T_LEN}), np.hstack([STATE[:, -8:-2], clip(STATE[:, -2:-1])]), {"eef_state": STATE[:, -6:]}),
    "maniskill_dataset_converted_externally_to_rlds": (arm, None, {"gripper_state": STATE[:, 7:8]}),
    "cmu_franka_exploration_dataset_converted_externally_to_rlds": (arm, ARM[:, :-1], {}),
    "imperialcollege_sawyer_wrist_cam": (arm, ARM[:, :-1], {}),
    "ucsd_kitchen_dataset_converted_externally_to_rlds": (arm, ARM[:, :-1], {"joint_state": STATE[:, :7]}),
    "ucsd_pick_and_place_dataset_converted_externally_to_rlds": (arm, np.hstack([ARM[:, :3], zeros(3), LAST]), EEF),
    "austin_sailor_dataset_converted_externally_to_rlds": (arm, flip, {}),
    "austin_sirius_dataset_converted_externally_to_rlds": (arm, flip, {}),
    "bc_z": (dict(action={"future/xyz_residual": STATE, "future/axis_angle_residual": ARM, "future/target_close": ARM[:, :2]}), np.hstack([STATE[:, :3], ARM[:, :3], 1 - ARM[:, :1]]), {}),
    "utokyo_pr2_opening_fridge_converted_externally_to_rlds": (arm, ARM[:, :-1], EEF),
    "utokyo_xarm_pick_and_place_converted_externally_to_rlds": (arm, None, {}),
    "utokyo_xarm_bimanual_converted_externally_to_rlds": (dict(action=STATE), STATE[:, -7:], {}),
    "robo_net": (arm, FOUR, {"eef_state": np.hstack([STATE[:, :4], zeros(2)])}),
    "kaist_nonprehensile_converted_externally_to_rlds": (arm, np.hstack([ARM[:, :6], zeros(1)]), {"state": STATE[:, -7:]}),
    "stanford_mask_vit_converted_externally_to_rlds": (dict(action=ARM, observation={"end_effector_pose": STATE}), FOUR, {"eef_state": np.hstack([STATE[:, :4], zeros(2)]), "gripper_state": STATE[:, -1:]}),
    "tokyo_u_lsmo_converted_externally_to_rlds": (arm, None, EEF),
    "stanford_robocook_converted_externally_to_rlds": (arm, None, EEF),
    "dlr_sara_grid_clamp_converted_externally_to_rlds": (arm, None, {"state": STATE[:, :6]}),
    "dlr_edan_shared_control_converted_externally_to_rlds": (arm, np.hstack([ARM[:, :6], 1 - LAST]), {}),
    "asu_table_top_converted_externally_to_rlds": (arm | {"ground_truth_states": {"EE": POSE}}, None, {"eef_state": POSE}),
    "uiuc_d3field": (dict(action=ARM[:, :3]), np.hstack([ARM[:, :3], zeros(4)]), {}),
    "berkeley_fanuc_manipulation": (dict(action=POSE, observation={"state": STATE}), np.hstack([POSE, 1 - STATE[:, 6:7]]), {"joint_state": STATE[:, :6]}),
    "cmu_play_fusion": (arm, np.hstack([ARM[:, :3], ARM[:, -4:]]), {}),
    "cmu_stretch": (arm, ARM[:, :-1], {"eef_state": np.hstack([STATE[:, :3], zeros(3)])}),
    "berkeley_gnm_sac_son": (dict(action=XY, observation={"position": XY, "yaw": POSE_GRIP, "state": STATE}), np.hstack([XY, zeros(5)]), {"state": np.hstack([XY, zeros(3), POSE_GRIP])}),
    "droid": (DROID_RAW, *DROID_OUT),
    "droid_wipe": (DROID_RAW, *DROID_OUT),
    "fmb_dataset": (dict(action=ARM, observation={"eef_pose": POSE, "state_gripper_pose": OPEN}), None, {"proprio": np.hstack([POSE, OPEN[:, None]])}),
    "dobbe": (arm, None, {"proprio": STATE}),
    "roboset": (arm, np.hstack([ARM[:, :7], 1 - clip(LAST)]), {"proprio": STATE}),
    "rh20t": (dict(action={"tcp_base": POSE, "gripper": OPEN}, observation={"tcp_base": POSE, "gripper_width": OPEN}), np.hstack([POSE, OPEN[:, None]]), {"proprio": np.hstack([POSE, OPEN[:, None]])}),
    "libero_goal_no_noops": (arm7, *LIBERO),
}


def values(x, t):
    v = x[t]
    return v.tolist() if isinstance(v, np.ndarray) else float(v) if isinstance(v, np.floating) else v


def kind(v):
    if isinstance(v, list):
        return f"array<{kind(v[0])}>"
    return {float: "double", int: "int", str: "string"}[type(v)]


def raw_table(spark, raw):
    observation = dict(raw.get("observation", {})) | {"natural_language_instruction": ["say it"] * T_LEN}
    parts = {"observation": observation, **{k: v for k, v in raw.items() if k != "observation"}}
    row = lambda p, t: tuple(values(x, t) for x in p.values()) if isinstance(p, dict) else values(p, t)
    struct = lambda p: "struct<" + ",".join(f"`{k}`:{kind(values(x, 0))}" for k, x in p.items()) + ">" if isinstance(p, dict) else kind(values(p, 0))
    schema = "dataset_name string, episode_id long, timestep int, language_instruction string, " + ", ".join(f"{k} {struct(p)}" for k, p in parts.items())
    rows = [("d", 1, t, "given", *[row(p, t) for p in parts.values()]) for t in range(T_LEN)]
    df = spark.createDataFrame(rows, schema)
    return E.with_timestep(df, F.col("timestep"))


@pytest.mark.parametrize("dataset", list(CASES))
def test_recipe(spark, dataset):
    raw, action, fields = CASES[dataset]
    got = S.standardize(raw_table(spark, raw), dataset, 1).orderBy("timestep").collect()
    if action is not None:
        assert np.allclose([r["action"] for r in got], action)
    assert [r["timestep"] for r in got] == list(range(len(got)))
    for name, want in fields.items():
        assert np.allclose([r["observation"][name] for r in got], want)
    if dataset == "language_table":
        assert {r["language_instruction"] for r in got} == {"hi"}
    elif S.registry()[dataset].language is not None:
        assert {r["language_instruction"] for r in got} == {"say it"}
    else:
        assert {r["language_instruction"] for r in got} == {"given"}
    if dataset == "droid":
        seen = {(r["observation"]["exterior_image_1_left"], r["observation"]["exterior_image_2_left"]) for r in got}
        assert seen in ({("l", "r")}, {("r", "l")})


def test_every_layout_and_name_is_covered():
    by_id = {id(r): n for n, r in S.LAYOUTS.items()}
    tested = {by_id[id(S.registry()[d])] for d in CASES}
    # rotations have their own round-trip and oracle checks; "droid_wrist" is an unregistered variant with an oracle
    assert set(S.LAYOUTS) - tested == {"furniture", "iamlab", "food", "droid_wrist"}
    assert len(S.registry()) == 73
    with pytest.raises(KeyError):
        S.registry()["unknown"]


def test_catalog():
    configs, mixes = catalog.datasets(), catalog.mixtures()
    assert len(configs) == 70 and len(mixes) == 18
    assert set(S.registry()) - set(configs) == {"ppgm", "ppgm_static", "ppgm_wrist"}
    assert set(configs) <= set(S.registry())
    assert {d for m in mixes.values() for d, _ in m} <= set(configs)
    assert [n for n, c in configs.items() if not c.loadable] == [
        "berkeley_mvp_converted_externally_to_rlds", "berkeley_rpt_converted_externally_to_rlds", "roboset",
    ]
    assert len(mixes["rtx_franka"]) == 28 and len({d for d, _ in mixes["rtx_franka"]}) == 24
    assert catalog.mixture_spec("kuka") == [("kuka", 1.0)]


@pytest.mark.parametrize("length", [1, 2, 3])
def test_short_bridge_episodes(spark, length):
    raw, *_ = CASES["bridge_orig"]
    got = S.standardize(raw_table(spark, raw).filter(F.col("timestep") < length), "bridge_orig").count()
    assert got == max(0, length - 2)


def test_many_datasets_at_once(spark):
    """One call for all layouts gives what the recipe of each dataset gives, over blocks of two steps."""
    parts = []
    for number, (dataset, (raw, *_)) in enumerate(CASES.items()):
        parts.append(S.to_slots(raw_table(spark, raw).withColumn("episode_id", F.lit(number).cast("long")), dataset))
    steps = parts[0]
    for p in parts[1:]:
        steps = steps.unionByName(p)
    rows = S.standardize_mixed(steps, rows=2).collect()
    assert len(steps.columns) == len(S.SLOT_KEYS) + 1 + S.slot_count()
    for dataset, (raw, action, fields) in CASES.items():
        got = sorted((r for r in rows if r["dataset_name"] == dataset), key=lambda r: r["timestep"])
        if action is not None:
            assert np.allclose([r["action"] for r in got], action), dataset
        assert [r["timestep"] for r in got] == list(range(len(got))), dataset
        recipe = S.registry()[dataset]
        assert {n for r in got for n in r["observation"]} == set(recipe.fields)
        for name in recipe.fields:
            if name in fields:
                assert np.allclose([r["observation"][name] for r in got], fields[name]), (dataset, name)
        assert {r["language_instruction"] for r in got} == {"hi" if dataset == "language_table" else "say it" if recipe.language is not None else "given"}


def test_unregistered_datasets_are_an_error(spark):
    raw, *_ = CASES["bridge_orig"]
    steps = S.to_slots(raw_table(spark, raw), "bridge_orig").withColumn("dataset_name", F.lit("unknown"))
    with pytest.raises(Exception, match="no recipe"):
        S.standardize_mixed(steps).collect()
