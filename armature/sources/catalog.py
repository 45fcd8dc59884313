"""Dataset and mixture catalog.

Both tables are read by people and by jobs: `datasets()` and `mixtures()` parse them once, and
`dataset_table(spark)` / `mixture_table(spark, name)` hand them to Spark as local relations whose row count is
known on the driver (70 configs, at most 28 entries per mixture), which is what makes them safe to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Dataset | state encoding | action encoding | images primary secondary wrist | depth primary secondary
# wrist | proprio keys. "-" is a camera that is filled with padding, "0" a proprio entry that is one zero.
DATASETS = """
fractal20220817_data | POS_QUAT | EEF_POS | image - - | - - - | base_pose_tool_reached gripper_closed
kuka | POS_QUAT | EEF_POS | image - - | - - - | clip_function_input/base_pose_tool_reached gripper_closed
bridge_oxe | POS_EULER | EEF_POS | image image_1 - | - - - | EEF_state 0 gripper_state
bridge_orig | POS_EULER | EEF_POS | image_0 image_1 - | - - - | EEF_state 0 gripper_state
bridge_dataset | POS_EULER | EEF_POS | image_0 image_1 - | - - - | EEF_state 0 gripper_state
taco_play | POS_EULER | EEF_POS | rgb_static - rgb_gripper | depth_static - depth_gripper | state_eef 0 state_gripper
jaco_play | POS_EULER | EEF_POS | image - image_wrist | - - - | state_eef 0 state_gripper
berkeley_cable_routing | JOINT | EEF_POS | image top_image wrist45_image | - - - | robot_state 0
roboturk | NONE | EEF_POS | front_rgb - - | - - - | 0 0 0 0 0 0 0 0
nyu_door_opening_surprising_effectiveness | NONE | EEF_POS | - - image | - - - | 0 0 0 0 0 0 0 0
viola | JOINT | EEF_POS | agentview_rgb - eye_in_hand_rgb | - - - | joint_states gripper_states
berkeley_autolab_ur5 | POS_QUAT | EEF_POS | image - hand_image | depth - - | state
toto | JOINT | EEF_POS | image - - | - - - | state 0
language_table | POS_EULER | EEF_POS | rgb - - | - - - | effector_translation 0 0 0 0 0 0
columbia_cairlab_pusht_real | POS_EULER | EEF_POS | image - wrist_image | - - - | robot_state 0 0 0 0 0 0
stanford_kuka_multimodal_dataset_converted_externally_to_rlds | POS_QUAT | EEF_POS | image - - | depth_image - - | ee_position ee_orientation 0
nyu_rot_dataset_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | eef_state 0 gripper_state
stanford_hydra_dataset_converted_externally_to_rlds | POS_EULER | EEF_POS | image - wrist_image | - - - | eef_state 0 gripper_state
austin_buds_dataset_converted_externally_to_rlds | JOINT | EEF_POS | image - wrist_image | - - - | state
nyu_franka_play_dataset_converted_externally_to_rlds | POS_EULER | EEF_POS | image image_additional_view - | depth depth_additional_view - | eef_state 0 0
maniskill_dataset_converted_externally_to_rlds | POS_QUAT | EEF_POS | image - wrist_image | depth - wrist_depth | tcp_pose gripper_state
furniture_bench_dataset_converted_externally_to_rlds | POS_QUAT | EEF_POS | image - wrist_image | - - - | state
cmu_franka_exploration_dataset_converted_externally_to_rlds | NONE | EEF_POS | highres_image - - | - - - | 0 0 0 0 0 0 0 0
ucsd_kitchen_dataset_converted_externally_to_rlds | JOINT | EEF_POS | image - - | - - - | joint_state 0
ucsd_pick_and_place_dataset_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | eef_state 0 gripper_state
austin_sailor_dataset_converted_externally_to_rlds | POS_QUAT | EEF_POS | image - wrist_image | - - - | state
austin_sirius_dataset_converted_externally_to_rlds | POS_QUAT | EEF_POS | image - wrist_image | - - - | state
bc_z | POS_EULER | EEF_POS | image - - | - - - | present/xyz present/axis_angle 0 present/sensed_close
utokyo_pr2_opening_fridge_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | eef_state 0 gripper_state
utokyo_pr2_tabletop_manipulation_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | eef_state 0 gripper_state
utokyo_xarm_pick_and_place_converted_externally_to_rlds | POS_EULER | EEF_POS | image image2 hand_image | - - - | end_effector_pose 0 0
utokyo_xarm_bimanual_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | pose_r 0 0
robo_net | POS_EULER | EEF_POS | image image1 - | - - - | eef_state 0 gripper_state
berkeley_mvp_converted_externally_to_rlds | POS_QUAT | JOINT_POS | - - hand_image | - - - | pose gripper
berkeley_rpt_converted_externally_to_rlds | JOINT | JOINT_POS | - - hand_image | - - - | joint_pos gripper
kaist_nonprehensile_converted_externally_to_rlds | POS_QUAT | EEF_POS | image - - | - - - | state 0
stanford_mask_vit_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | eef_state 0 gripper_state
tokyo_u_lsmo_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | eef_state 0 gripper_state
dlr_sara_pour_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | state 0 0
dlr_sara_grid_clamp_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | state 0 0
dlr_edan_shared_control_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | state 0
asu_table_top_converted_externally_to_rlds | POS_EULER | EEF_POS | image - - | - - - | eef_state 0 gripper_state
stanford_robocook_converted_externally_to_rlds | POS_EULER | EEF_POS | image_1 image_2 - | depth_1 depth_2 - | eef_state 0 gripper_state
imperialcollege_sawyer_wrist_cam | NONE | EEF_POS | image - wrist_image | - - - | 0 0 0 0 0 0 0 state
iamlab_cmu_pickup_insert_converted_externally_to_rlds | JOINT | EEF_POS | image - wrist_image | - - - | joint_state gripper_state
uiuc_d3field | NONE | EEF_POS | image_1 image_2 - | depth_1 depth_2 - | 0 0 0 0 0 0 0 0
utaustin_mutex | JOINT | EEF_POS | image - wrist_image | - - - | state
berkeley_fanuc_manipulation | JOINT | EEF_POS | image - wrist_image | - - - | joint_state 0 gripper_state
cmu_playing_with_food | POS_EULER | EEF_POS | image - finger_vision_1 | - - - | state 0 0
cmu_play_fusion | JOINT | EEF_POS | image - - | - - - | state
cmu_stretch | POS_EULER | EEF_POS | image - - | - - - | eef_state 0 gripper_state
berkeley_gnm_recon | POS_EULER | EEF_POS | - - image | - - - | state 0 0
berkeley_gnm_cory_hall | POS_EULER | EEF_POS | - - image | - - - | state 0 0
berkeley_gnm_sac_son | POS_EULER | EEF_POS | - - image | - - - | state 0 0
droid | POS_QUAT | EEF_POS | exterior_image_1_left exterior_image_2_left wrist_image_left | - - - | proprio
fmb_dataset | POS_EULER | EEF_POS | image_side_1 image_side_2 image_wrist_1 | image_side_1_depth image_side_2_depth image_wrist_1_depth | proprio
dobbe | POS_EULER | EEF_POS | wrist_image - - | - - - | proprio
roboset | JOINT | JOINT_POS | image_left image_right image_wrist | - - - | proprio
rh20t | POS_EULER | EEF_POS | image_front image_side_right image_wrist | - - - | proprio
tdroid_carrot_in_bowl | POS_EULER | EEF_POS | static_image - - | static_depth_image - - | EEF_state 0 gripper_state
tdroid_pour_corn_in_pot | POS_EULER | EEF_POS | static_image - - | static_depth_image - - | EEF_state 0 gripper_state
tdroid_flip_pot_upright | POS_EULER | EEF_POS | static_image - - | static_depth_image - - | EEF_state 0 gripper_state
tdroid_move_object_onto_plate | POS_EULER | EEF_POS | static_image - - | static_depth_image - - | EEF_state 0 gripper_state
tdroid_knock_object_over | POS_EULER | EEF_POS | static_image - - | static_depth_image - - | EEF_state 0 gripper_state
tdroid_cover_object_with_towel | POS_EULER | EEF_POS | static_image - - | static_depth_image - - | EEF_state 0 gripper_state
droid_wipe | POS_EULER | EEF_POS | exterior_image_2_left - wrist_image_left | - - - | proprio
libero_spatial_no_noops | POS_EULER | EEF_POS | image - wrist_image | - - - | EEF_state 0 gripper_state
libero_object_no_noops | POS_EULER | EEF_POS | image - wrist_image | - - - | EEF_state 0 gripper_state
libero_goal_no_noops | POS_EULER | EEF_POS | image - wrist_image | - - - | EEF_state 0 gripper_state
libero_10_no_noops | POS_EULER | EEF_POS | image - wrist_image | - - - | EEF_state 0 gripper_state
"""

# Mixture name, then its "dataset weight" entries in order. Repeated datasets are part of the list.
MIXTURES = """
bridge:
    bridge_orig 1.0
bridge_rt_1:
    bridge_orig 1.0
    fractal20220817_data 1.0
rtx:
    fractal20220817_data 0.54087122203
    kuka 0.8341046294
    bridge_orig 1.0
    taco_play 2.0
    jaco_play 2.0
    berkeley_cable_routing 3.0
    roboturk 1.0
    viola 2.0
    berkeley_autolab_ur5 1.0
    toto 1.0
rtx_franka:
    fractal20220817_data 0.54087122203
    kuka 0.8341046294
    bridge_orig 1.0
    taco_play 2.0
    jaco_play 2.0
    berkeley_cable_routing 3.0
    roboturk 1.0
    viola 2.0
    berkeley_autolab_ur5 1.0
    toto 1.0
    taco_play 1.0
    berkeley_cable_routing 1.0
    viola 1.0
    toto 1.0
    stanford_hydra_dataset_converted_externally_to_rlds 1.0
    austin_buds_dataset_converted_externally_to_rlds 3.0
    nyu_franka_play_dataset_converted_externally_to_rlds 3.0
    maniskill_dataset_converted_externally_to_rlds 0.1
    furniture_bench_dataset_converted_externally_to_rlds 0.1
    cmu_franka_exploration_dataset_converted_externally_to_rlds 5.0
    austin_sailor_dataset_converted_externally_to_rlds 1.0
    austin_sirius_dataset_converted_externally_to_rlds 1.0
    berkeley_rpt_converted_externally_to_rlds 1.0
    kaist_nonprehensile_converted_externally_to_rlds 3.0
    stanford_robocook_converted_externally_to_rlds 1.0
    iamlab_cmu_pickup_insert_converted_externally_to_rlds 1.0
    utaustin_mutex 1.0
    cmu_play_fusion 1.0
oxe_magic_soup:
    fractal20220817_data 0.54087122203
    kuka 0.8341046294
    bridge_orig 1.0
    taco_play 2.0
    jaco_play 1.0
    berkeley_cable_routing 1.0
    roboturk 2.0
    viola 2.0
    berkeley_autolab_ur5 2.0
    toto 1.0
    language_table 0.1
    stanford_hydra_dataset_converted_externally_to_rlds 2.0
    austin_buds_dataset_converted_externally_to_rlds 1.0
    nyu_franka_play_dataset_converted_externally_to_rlds 3.0
    furniture_bench_dataset_converted_externally_to_rlds 0.1
    ucsd_kitchen_dataset_converted_externally_to_rlds 2.0
    austin_sailor_dataset_converted_externally_to_rlds 1.0
    austin_sirius_dataset_converted_externally_to_rlds 1.0
    dlr_edan_shared_control_converted_externally_to_rlds 1.0
    iamlab_cmu_pickup_insert_converted_externally_to_rlds 1.0
    utaustin_mutex 1.0
    berkeley_fanuc_manipulation 2.0
    cmu_stretch 1.0
oxe_magic_soup_plus:
    fractal20220817_data 0.54087122203
    kuka 0.8341046294
    bridge_orig 1.0
    taco_play 2.0
    jaco_play 1.0
    berkeley_cable_routing 1.0
    roboturk 2.0
    viola 2.0
    berkeley_autolab_ur5 2.0
    toto 1.0
    language_table 0.1
    stanford_hydra_dataset_converted_externally_to_rlds 2.0
    austin_buds_dataset_converted_externally_to_rlds 1.0
    nyu_franka_play_dataset_converted_externally_to_rlds 3.0
    furniture_bench_dataset_converted_externally_to_rlds 0.1
    ucsd_kitchen_dataset_converted_externally_to_rlds 2.0
    austin_sailor_dataset_converted_externally_to_rlds 1.0
    austin_sirius_dataset_converted_externally_to_rlds 1.0
    dlr_edan_shared_control_converted_externally_to_rlds 1.0
    iamlab_cmu_pickup_insert_converted_externally_to_rlds 1.0
    utaustin_mutex 1.0
    berkeley_fanuc_manipulation 2.0
    cmu_stretch 1.0
    bc_z 0.2
    fmb_dataset 1.0
    dobbe 0.2
    droid 0.06
oxe_magic_soup_plus_minus:
    fractal20220817_data 1.0
    kuka 0.8341046294
    bridge_orig 1.0
    taco_play 2.0
    jaco_play 1.0
    berkeley_cable_routing 1.0
    roboturk 2.0
    viola 2.0
    berkeley_autolab_ur5 2.0
    toto 1.0
    stanford_hydra_dataset_converted_externally_to_rlds 2.0
    austin_buds_dataset_converted_externally_to_rlds 1.0
    nyu_franka_play_dataset_converted_externally_to_rlds 3.0
    furniture_bench_dataset_converted_externally_to_rlds 0.1
    ucsd_kitchen_dataset_converted_externally_to_rlds 2.0
    austin_sailor_dataset_converted_externally_to_rlds 1.0
    austin_sirius_dataset_converted_externally_to_rlds 1.0
    dlr_edan_shared_control_converted_externally_to_rlds 1.0
    iamlab_cmu_pickup_insert_converted_externally_to_rlds 1.0
    utaustin_mutex 1.0
    berkeley_fanuc_manipulation 2.0
    cmu_stretch 1.0
    bc_z 0.2
    fmb_dataset 1.0
    dobbe 0.2
tdroid_carrot_in_bowl:
    tdroid_carrot_in_bowl 1.0
tdroid_pour_corn_in_pot:
    tdroid_pour_corn_in_pot 1.0
tdroid_flip_pot_upright:
    tdroid_flip_pot_upright 1.0
tdroid_move_object_onto_plate:
    tdroid_move_object_onto_plate 1.0
tdroid_knock_object_over:
    tdroid_knock_object_over 1.0
tdroid_cover_object_with_towel:
    tdroid_cover_object_with_towel 1.0
droid_wipe:
    droid_wipe 1.0
libero_spatial_no_noops:
    libero_spatial_no_noops 1.0
libero_object_no_noops:
    libero_object_no_noops 1.0
libero_goal_no_noops:
    libero_goal_no_noops 1.0
libero_10_no_noops:
    libero_10_no_noops 1.0
"""


VIEWS = ("primary", "secondary", "wrist")
#: Action layouts that can be loaded and the number of dimensions of each; the last one is the absolute gripper.
LOADABLE_ACTION_DIMS = {"EEF_POS": 7, "EEF_R6": 10}


@dataclass(frozen=True)
class DatasetConfig:
    name: str
    state_encoding: str
    action_encoding: str
    images: dict[str, str | None]
    depths: dict[str, str | None]
    proprio: tuple[str | None, ...]

    @property
    def loadable(self) -> bool:
        return self.action_encoding in LOADABLE_ACTION_DIMS


def _cameras(cell: str) -> dict[str, str | None]:
    return {view: None if key == "-" else key for view, key in zip(VIEWS, cell.split())}


def datasets() -> dict[str, DatasetConfig]:
    """Name -> config of every catalogued dataset, in catalog order."""
    found = {}
    for line in DATASETS.strip().splitlines():
        name, state, action, images, depths, proprio = (cell.strip() for cell in line.split("|"))
        keys = tuple(None if key == "0" else key for key in proprio.split())
        found[name] = DatasetConfig(name, state, action, _cameras(images), _cameras(depths), keys)
    return found


def mixtures() -> dict[str, list[tuple[str, float]]]:
    """Name -> ordered (dataset, weight) list of every named mixture."""
    found: dict[str, list[tuple[str, float]]] = {}
    for line in MIXTURES.strip().splitlines():
        if line.endswith(":"):
            current = found.setdefault(line[:-1], [])
        else:
            name, weight = line.split()
            current.append((name, float(weight)))
    return found


def mixture_spec(name: str) -> list[tuple[str, float]]:
    """Entries of a mixture; a name that is no mixture is one dataset with weight 1."""
    return mixtures().get(name, [(name, 1.0)])


def dataset_table(spark: SparkSession) -> DataFrame:
    rows = [(c.name, c.state_encoding, c.action_encoding, c.loadable) for c in datasets().values()]
    return spark.createDataFrame(rows, "dataset_name string, state_encoding string, action_encoding string, loadable boolean")


def all_mixtures(spark: SparkSession) -> DataFrame:
    rows = [(name, pos, dataset, weight) for name, entries in mixtures().items() for pos, (dataset, weight) in enumerate(entries)]
    return spark.createDataFrame(rows, "mixture string, pos int, dataset_name string, weight double")


def mixture_table(spark: SparkSession, name: str) -> DataFrame:
    rows = [(pos, dataset, weight) for pos, (dataset, weight) in enumerate(mixture_spec(name))]
    return spark.createDataFrame(rows, "pos int, dataset_name string, weight double")
