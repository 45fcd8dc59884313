"""Per-dataset standardization as data: one recipe per raw layout, one interpreter for all of them.

A recipe lists the pieces of the new action and of new observation fields. Pieces are column expressions over the raw
step (`action`, `observation.*`, `action_dict.*`, ...), so a dataset becomes a single projection; only recipes with a
gripper scan, a dropped first step or reached-state relabeling touch other steps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.functions import rotation, text
from armature.functions import vectors as V
from armature.functions.chance import uniform
from armature.operators.episodes import SEGMENT_ROWS, with_scans
from armature.operators.layout import quoted
from armature.operators.motion import absolute_gripper, binarize_gripper, drop_first_step, relabel_by_reached_state


class Raw:
    """Reads raw fields of one dataset by their paths."""

    def vector(self, path: str) -> Column:
        return V.doubles(quoted(path))

    def number(self, path: str) -> Column:
        return quoted(path).cast("double")

    def text(self, path: str) -> Column:
        return quoted(path)

    def points(self, path: str) -> Column:
        return text.from_code_points(quoted(path))

    def scanned(self) -> Column:
        return F.col("__gripper")


class Slots(Raw):
    """Reads the same fields from the common slots of steps of many datasets; see `to_slots`."""

    def __init__(self, slots: Mapping[str, str]):
        self.slots = slots

    def vector(self, path: str) -> Column:
        return F.col(self.slots[path])

    def number(self, path: str) -> Column:
        return V.at(self.slots[path], 0)

    def text(self, path: str) -> Column:
        return F.col(self.slots[path])

    points = text


class Listing(Raw):
    """Notes which fields are read and how, in order."""

    def __init__(self):
        self.fields: dict[str, str] = {}

    def _note(self, path: str, how: str) -> Column:
        self.fields.setdefault(path, how)
        return F.lit(None).cast("array<double>" if how == "vector" else "double" if how == "number" else "string")

    def vector(self, path: str) -> Column:
        return self._note(path, "vector")

    def number(self, path: str) -> Column:
        return self._note(path, "number")

    def text(self, path: str) -> Column:
        return self._note(path, "text")

    def points(self, path: str) -> Column:
        return self._note(path, "points")


Piece = Callable[[Raw], Column]


@dataclass(frozen=True)
class Recipe:
    action: Sequence[Piece] | None = None
    fields: Mapping[str, Sequence[Piece]] = field(default_factory=dict)
    renamed: Mapping[str, str] = field(default_factory=dict)
    first_channel: Sequence[str] = ()
    language: Piece | None = None
    gripper: tuple[str, Piece] | None = None  # ("binary" | "relative", raw value) -> piece `scanned`
    drop_first: bool = False
    reached_state: bool = False
    swap_exterior: bool = False


# Pieces -------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Cut:
    """A Python slice of a raw vector."""

    path: str
    start: int = 0
    stop: int | None = None

    def __call__(self, r: Raw) -> Column:
        v = r.vector(self.path)
        return v if self.start == 0 and self.stop is None else V.span(v, self.start, self.stop)


@dataclass(frozen=True)
class One:
    """One element of a raw vector, clipped to 0..1 or turned over."""

    path: str
    i: int
    clip: bool = False
    flip: bool = False

    def __call__(self, r: Raw) -> Column:
        x = V.at(r.vector(self.path), self.i)
        x = A.clip_gripper(x) if self.clip else x
        return F.array(A.invert_gripper(x) if self.flip else x)


def whole(path: str) -> Piece:
    return Cut(path)


def cut(path: str, start: int, stop: int | None = None) -> Piece:
    return Cut(path, start, stop)


def scalar(path: str) -> Piece:
    return lambda r: F.array(r.number(path))


def fill(n: int, value: float = 0.0) -> Piece:
    return lambda r: F.array(*[F.lit(value)] * n)


def flipped(path: str, i: int = -1) -> Piece:
    return One(path, i, flip=True)


def clipped(path: str, i: int = -1) -> Piece:
    return One(path, i, clip=True)


def clipped_flipped(path: str, i: int = -1) -> Piece:
    return One(path, i, clip=True, flip=True)


def scanned(r: Raw) -> Column:
    return F.array(r.scanned())


def euler_of(path: str, start: int) -> Piece:
    def piece(r: Raw) -> Column:
        q = [r.vector(path)[start + i] for i in range(4)]
        return F.array(*rotation.quaternion_to_euler(*q))

    return piece


def wrist_velocity(velocity: str, pose: str) -> Piece:
    def piece(r: Raw) -> Column:
        v, p = r.vector(velocity), r.vector(pose)
        return F.array(*rotation.velocity_in_wrist_frame([v[i] for i in range(6)], [p[i] for i in range(3, 6)]))

    return piece


def spoken(path: str = "observation.natural_language_instruction") -> Piece:
    return lambda r: r.text(path)


def code_points(path: str) -> Piece:
    return lambda r: r.points(path)


# Recipes ------------------------------------------------------------------------------------------------------------

STATE = "observation.state"
SPLIT_ACTION = [whole("action.world_vector"), whole("action.rotation_delta")]
CLOSEDNESS = "action.gripper_closedness_action"


def eef(path: str = STATE, name: str = "eef_state", stop: int = 6) -> dict[str, list[Piece]]:
    return {name: [cut(path, 0, stop)], "gripper_state": [cut(path, -1)]}


ARM = eef(name="EEF_state")
TELEOP = {"EEF_state": [cut("observation.cartesian_position", 0, 6)], "gripper_state": [cut("observation.gripper_position", -1)]}
BINARY = dict(action=[cut("action", 0, 6), scanned], gripper=("binary", lambda r: V.at(r.vector("action"), -1)))
RELATIVE = dict(
    action=[*SPLIT_ACTION, scanned],
    gripper=("relative", lambda r: V.at(r.vector(CLOSEDNESS), 0)),
    language=spoken(),
)
SEVEN_CLIPPED_FLIPPED = [cut("action", 0, 6), clipped_flipped("action")]
SHORT_XYZ = [cut("action", 0, 3), fill(3), cut("action", -1)]
FOUR_DOF = [cut("action", 0, 4), fill(2), cut("action", -1)]
WITHOUT_LAST = [cut("action", 0, -1)]
DROID_PROPRIO = {"proprio": [whole("observation.cartesian_position"), whole("observation.gripper_position")]}
DROID_BASE = [cut("action_dict.cartesian_velocity", 0, 6), flipped("action_dict.gripper_position", 0)]

LAYOUTS: dict[str, Recipe] = {
    "bridge_split": Recipe(
        [*SPLIT_ACTION, scalar("action.open_gripper")], ARM, language=spoken(), drop_first=True, reached_state=True
    ),
    "bridge": Recipe(fields=ARM, drop_first=True, reached_state=True, **BINARY),
    "teleop": Recipe(fields=TELEOP, **BINARY),
    "relative": Recipe(**RELATIVE),
    "taco": Recipe(
        [cut("action.rel_actions_world", 0, 6), clipped("action.rel_actions_world")],
        {"state_eef": [cut("observation.robot_obs", 0, 6)], "state_gripper": [cut("observation.robot_obs", 7, 8)]},
        language=spoken(),
    ),
    "jaco": Recipe(
        [whole("action.world_vector"), fill(3), scanned],
        {
            "state_eef": [cut("observation.end_effector_cartesian_pos", 0, 6)],
            "state_gripper": [cut("observation.end_effector_cartesian_pos", -1)],
        },
        language=spoken(),
        gripper=RELATIVE["gripper"],
    ),
    "cable": Recipe([*SPLIT_ACTION, fill(1)], language=spoken()),
    "roboturk": Recipe([*SPLIT_ACTION, clipped_flipped(CLOSEDNESS, 0)], language=spoken()),
    "viola": Recipe(
        [*SPLIT_ACTION, lambda r: F.array(A.invert_gripper(A.clip_gripper(r.number(CLOSEDNESS))))],
        language=spoken(),
    ),
    "autolab": Recipe(
        [*SPLIT_ACTION, scanned],
        {"state": [cut("observation.robot_state", 6, 14)]},
        renamed={"image_with_depth": "depth"},
        language=spoken(),
        gripper=("relative", lambda r: r.number(CLOSEDNESS)),
    ),
    "toto": Recipe([*SPLIT_ACTION, scalar("action.open_gripper")], language=spoken()),
    "language_table": Recipe(
        [whole("action"), fill(2), fill(2), fill(1, 1.0)], language=code_points("observation.instruction")
    ),
    "pusht": Recipe([*SPLIT_ACTION, scalar(CLOSEDNESS)], language=spoken()),
    "kuka_multimodal": Recipe(SHORT_XYZ, first_channel=["depth_image"]),
    "nyu_rot": Recipe([cut("action", 0, 7)], eef()),
    "hydra": Recipe(
        [cut("action", 0, 6), flipped("action")],
        {"eef_state": [cut(STATE, 0, 3), cut(STATE, 7, 10)], "gripper_state": [cut(STATE, -3, -2)]},
    ),
    "state8": Recipe(SEVEN_CLIPPED_FLIPPED, {"state": [cut(STATE, 0, 8)]}),
    "franka_play": Recipe(
        [cut("action", -8, -2), clipped("action", -2)],
        {"eef_state": [cut(STATE, -6)]},
        first_channel=["depth", "depth_additional_view"],
    ),
    "maniskill": Recipe(fields={"gripper_state": [cut(STATE, 7, 8)]}),
    "furniture": Recipe(
        [cut("action", 0, 3), euler_of("action", 3), clipped_flipped("action")],
        {"state": [cut(STATE, 0, 7), cut(STATE, -1)]},
    ),
    "without_last": Recipe(WITHOUT_LAST),
    "joints_without_last": Recipe(WITHOUT_LAST, {"joint_state": [cut(STATE, 0, 7)]}),
    "pick_place": Recipe(SHORT_XYZ, eef()),
    "clipped_flipped": Recipe(SEVEN_CLIPPED_FLIPPED),
    "bc_z": Recipe(
        [cut("action.future/xyz_residual", 0, 3), cut("action.future/axis_angle_residual", 0, 3), flipped("action.future/target_close", 0)],
        language=spoken(),
    ),
    "eef_without_last": Recipe(WITHOUT_LAST, eef()),
    "as_is": Recipe(),
    "last_seven": Recipe([cut("action", -7)]),
    "robo_net": Recipe(FOUR_DOF, {"eef_state": [cut(STATE, 0, 4), fill(2)], "gripper_state": [cut(STATE, -1)]}),
    "kaist": Recipe([cut("action", 0, 6), fill(1)], {"state": [cut(STATE, -7)]}),
    "mask_vit": Recipe(
        FOUR_DOF,
        {
            "eef_state": [cut("observation.end_effector_pose", 0, 4), fill(2)],
            "gripper_state": [cut("observation.end_effector_pose", -1)],
        },
    ),
    "eef_only": Recipe(fields=eef()),
    "state6": Recipe(fields={"state": [cut(STATE, 0, 6)]}),
    "flipped": Recipe([cut("action", 0, 6), flipped("action")]),
    "asu": Recipe(fields={"eef_state": [whole("ground_truth_states.EE")], "gripper_state": [cut(STATE, -1)]}),
    "iamlab": Recipe(
        [cut("action", 0, 3), euler_of("action", 3), cut("action", 7, 8)],
        {"joint_state": [cut(STATE, 0, 7)], "gripper_state": [cut(STATE, 7, 8)]},
    ),
    "d3field": Recipe([whole("action"), fill(3), fill(1)]),
    "fanuc": Recipe(
        [whole("action"), flipped(STATE, 6)], {"joint_state": [cut(STATE, 0, 6)], "gripper_state": [cut(STATE, 6, 7)]}
    ),
    "food": Recipe([cut("action", 0, 3), euler_of("action", 3), cut("action", -1)]),
    "play_fusion": Recipe([cut("action", 0, 3), cut("action", -4)]),
    "stretch": Recipe(WITHOUT_LAST, {"eef_state": [cut(STATE, 0, 3), fill(3)], "gripper_state": [cut(STATE, -1)]}),
    "gnm": Recipe(
        [whole("action"), fill(2), fill(2), fill(1)],
        {"state": [whole("observation.position"), fill(3), whole("observation.yaw")]},
    ),
    "droid": Recipe(DROID_BASE, DROID_PROPRIO, swap_exterior=True),
    "droid_wrist": Recipe(
        [wrist_velocity("action_dict.cartesian_velocity", "observation.cartesian_position"), whole("action_dict.gripper_position")],
        DROID_PROPRIO,
        swap_exterior=True,
    ),
    "droid_single": Recipe(DROID_BASE, DROID_PROPRIO),
    "fmb": Recipe(fields={"proprio": [whole("observation.eef_pose"), scalar("observation.state_gripper_pose")]}),
    "dobbe": Recipe(fields={"proprio": [whole(STATE)]}),
    "roboset": Recipe([cut("action", 0, 7), clipped_flipped("action")], {"proprio": [whole(STATE)]}),
    "rh20t": Recipe(
        [whole("action.tcp_base"), scalar("action.gripper")],
        {"proprio": [whole("observation.tcp_base"), scalar("observation.gripper_width")]},
    ),
    "libero": Recipe(SEVEN_CLIPPED_FLIPPED, {"EEF_state": [cut(STATE, 0, 6)], "gripper_state": [cut(STATE, -2)]}),
}

# Registered dataset -> layout, in registry order.
REGISTRY = """
bridge_oxe bridge_split
bridge_orig bridge
bridge_dataset bridge
ppgm teleop
ppgm_static teleop
ppgm_wrist teleop
fractal20220817_data relative
kuka relative
taco_play taco
jaco_play jaco
berkeley_cable_routing cable
roboturk roboturk
nyu_door_opening_surprising_effectiveness relative
viola viola
berkeley_autolab_ur5 autolab
toto toto
language_table language_table
columbia_cairlab_pusht_real pusht
stanford_kuka_multimodal_dataset_converted_externally_to_rlds kuka_multimodal
nyu_rot_dataset_converted_externally_to_rlds nyu_rot
stanford_hydra_dataset_converted_externally_to_rlds hydra
austin_buds_dataset_converted_externally_to_rlds state8
nyu_franka_play_dataset_converted_externally_to_rlds franka_play
maniskill_dataset_converted_externally_to_rlds maniskill
furniture_bench_dataset_converted_externally_to_rlds furniture
cmu_franka_exploration_dataset_converted_externally_to_rlds without_last
ucsd_kitchen_dataset_converted_externally_to_rlds joints_without_last
ucsd_pick_and_place_dataset_converted_externally_to_rlds pick_place
austin_sailor_dataset_converted_externally_to_rlds clipped_flipped
austin_sirius_dataset_converted_externally_to_rlds clipped_flipped
bc_z bc_z
utokyo_pr2_opening_fridge_converted_externally_to_rlds eef_without_last
utokyo_pr2_tabletop_manipulation_converted_externally_to_rlds eef_without_last
utokyo_xarm_pick_and_place_converted_externally_to_rlds as_is
utokyo_xarm_bimanual_converted_externally_to_rlds last_seven
robo_net robo_net
berkeley_mvp_converted_externally_to_rlds as_is
berkeley_rpt_converted_externally_to_rlds as_is
kaist_nonprehensile_converted_externally_to_rlds kaist
stanford_mask_vit_converted_externally_to_rlds mask_vit
tokyo_u_lsmo_converted_externally_to_rlds eef_only
dlr_sara_pour_converted_externally_to_rlds as_is
dlr_sara_grid_clamp_converted_externally_to_rlds state6
dlr_edan_shared_control_converted_externally_to_rlds flipped
asu_table_top_converted_externally_to_rlds asu
stanford_robocook_converted_externally_to_rlds eef_only
imperialcollege_sawyer_wrist_cam without_last
iamlab_cmu_pickup_insert_converted_externally_to_rlds iamlab
uiuc_d3field d3field
utaustin_mutex state8
berkeley_fanuc_manipulation fanuc
cmu_playing_with_food food
cmu_play_fusion play_fusion
cmu_stretch stretch
berkeley_gnm_recon gnm
berkeley_gnm_cory_hall gnm
berkeley_gnm_sac_son gnm
droid droid
fmb_dataset fmb
dobbe dobbe
roboset roboset
rh20t rh20t
tdroid_carrot_in_bowl teleop
tdroid_pour_corn_in_pot teleop
tdroid_flip_pot_upright teleop
tdroid_move_object_onto_plate teleop
tdroid_knock_object_over teleop
tdroid_cover_object_with_towel teleop
droid_wipe droid_single
libero_spatial_no_noops libero
libero_object_no_noops libero
libero_goal_no_noops libero
libero_10_no_noops libero
"""


def registry() -> dict[str, Recipe]:
    pairs = (line.split() for line in REGISTRY.strip().splitlines())
    return {name: LAYOUTS[layout] for name, layout in pairs}


def swap_exterior_images(df: DataFrame, first: str, second: str, seed: int, keys: Sequence[str] = ("dataset_name", "episode_id")) -> DataFrame:
    """One coin flip per episode: keep the two views or exchange them."""
    keep = uniform(seed, *keys) > 0.5
    a, b = F.col(first), F.col(second)
    return df.withColumns({first: F.when(keep, a).otherwise(b), second: F.when(keep, b).otherwise(a)})


def apply_recipe(df: DataFrame, recipe: Recipe, seed: int = 0) -> DataFrame:
    if recipe.drop_first:
        df = drop_first_step(df)
    if recipe.gripper is not None:
        kind, raw = recipe.gripper
        scan = binarize_gripper if kind == "binary" else absolute_gripper
        df = scan(df, raw(Raw()), "__gripper")
    build = lambda pieces: F.concat(*[p(Raw()) for p in pieces])
    new = {}
    if recipe.action is not None:
        new["action"] = build(recipe.action)
    if recipe.language is not None:
        new["language_instruction"] = recipe.language(Raw())
    obs = F.col("observation")
    for name, pieces in recipe.fields.items():
        obs = obs.withField(name, build(pieces))
    for old, name in recipe.renamed.items():
        obs = obs.withField(name, quoted(f"observation.{old}")).dropFields(old)
    for name in recipe.first_channel:
        obs = obs.withField(name, F.transform(quoted(f"observation.{name}"), lambda px: px[0].cast("float")))
    if recipe.swap_exterior:
        keep = uniform(seed, "dataset_name", "episode_id") > 0.5
        left, right = (quoted(f"observation.exterior_image_{i}_left") for i in (1, 2))
        obs = obs.withField("exterior_image_1_left", F.when(keep, left).otherwise(right))
        obs = obs.withField("exterior_image_2_left", F.when(keep, right).otherwise(left))
    out = df.withColumns({**new, "observation": obs}).drop("__gripper")
    if recipe.reached_state:
        out = relabel_by_reached_state(out, quoted(STATE))
    return out


def standardize(df: DataFrame, dataset: str, seed: int = 0) -> DataFrame:
    """Apply the registered recipe of one dataset; an unregistered name is an error."""
    return apply_recipe(df, registry()[dataset], seed)


# Many datasets at once ----------------------------------------------------------------------------------------------

#: Columns of slotted steps besides the slots.
SLOT_KEYS = ("dataset_name", "episode_id", "timestep", "language_instruction")


def fields_read(recipe: Recipe) -> dict[str, str]:
    """Raw field -> how a recipe reads it ("vector", "number", "text", "points")."""
    seen = Listing()
    for pieces in [recipe.action or [whole("action")], *recipe.fields.values()]:
        for p in pieces:
            if p is not scanned:
                p(seen)
    if recipe.gripper is not None:
        recipe.gripper[1](seen)
    if recipe.reached_state:
        seen.vector(STATE)
    if recipe.language is not None:
        recipe.language(seen)
    return seen.fields


_SLOTS: dict[int, dict[str, str]] = {}


def slots_of(recipe: Recipe) -> dict[str, str]:
    """Raw field -> common slot: vectors and numbers go to slot0, slot1, ..., the instruction to slot_text."""
    if id(recipe) not in _SLOTS:
        how = fields_read(recipe)
        vectors = [p for p, kind in how.items() if kind in ("vector", "number")]
        _SLOTS[id(recipe)] = {p: f"slot{i}" for i, p in enumerate(vectors)} | {p: "slot_text" for p, kind in how.items() if kind in ("text", "points")}
    return _SLOTS[id(recipe)]


def slot_count() -> int:
    return max(sum(s != "slot_text" for s in slots_of(r).values()) for r in LAYOUTS.values())


def to_slots(df: DataFrame, dataset: str) -> DataFrame:
    """Raw steps of one dataset in the common layout: `SLOT_KEYS`, slot_text, slot0, slot1, ... as arrays of doubles. A projection."""
    how, slots = fields_read(registry()[dataset]), slots_of(registry()[dataset])
    raw, read = Raw(), {}
    for path, kind in how.items():
        read[slots[path]] = F.array(raw.number(path)) if kind == "number" else getattr(raw, kind)(path)
    numbers = [read.get(f"slot{i}", F.lit(None).cast("array<double>")).alias(f"slot{i}") for i in range(slot_count())]
    return df.select(F.lit(dataset).alias("dataset_name"), *SLOT_KEYS[1:], read.get("slot_text", F.lit(None).cast("string")).alias("slot_text"), *numbers)


def standardize_mixed(
    steps: DataFrame, datasets: Sequence[str] | None = None, order: Sequence[str] = ("timestep",), block: Column | None = None, rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Standardize slotted steps of many datasets together: `SLOT_KEYS`, `action`, and `observation`, the new vector fields by name.

    One scan, one shuffle of the steps and one set of window passes serve all datasets, whatever their recipes need: the
    gripper scans, the state that follows and the step numbers come from `with_scans`, and the rest is one projection that
    picks the recipe by `dataset_name`. Steps may come without `timestep` if `order` and `block` say how they follow each other.
    Rows of unregistered datasets raise an error. Images are no vectors: their columns are mapped by name elsewhere.
    """
    known = registry()
    names = list(known) if datasets is None else list(datasets)
    by_layout: dict[str, tuple[Recipe, list[str]]] = {}
    title = {id(r): n for n, r in LAYOUTS.items()}
    for name in names:
        by_layout.setdefault(title[id(known[name])], (known[name], []))[1].append(name)

    def one_of(of: Sequence[str]) -> Column:
        return F.expr(f"dataset_name IN ({', '.join(repr(n) for n in of)})") if of else F.lit(False)

    def choose(ways: dict) -> Column | None:
        """CASE over the datasets: value (a plain one, or a column under its text) -> names."""
        out = None
        for found, of in ways.values():
            out = F.when(one_of(of), found) if out is None else out.when(one_of(of), found)
        return out

    def per_row(value: Callable[[Recipe, Slots], object]) -> Column | None:
        """The value of the recipe of each row; null where a recipe has none. Recipes that say the same share a branch."""
        ways: dict = {}
        for recipe, of in by_layout.values():
            found = value(recipe, Slots(slots_of(recipe)))
            if found is not None:
                ways.setdefault(str(found), (found, []))[1].extend(of)
        return choose(ways)

    def any_of(test: Callable[[Recipe], bool]) -> Column:
        return F.coalesce(one_of([n for recipe, of in by_layout.values() if test(recipe) for n in of]), F.lit(False))

    def gripper(kind: str) -> Column:
        raw = per_row(lambda r, s: r.gripper[1](s) if r.gripper is not None and r.gripper[0] == kind else None)
        return F.lit(None).cast("double") if raw is None else raw

    none = F.lit(None).cast("array<double>")
    state = per_row(lambda r, s: s.vector(STATE) if r.reached_state else None)
    motion = A.gripper_motion(gripper("relative"))
    walked = with_scans(
        steps, order, block, rows=rows, position="timestep",
        forward={"__held": motion}, first={"__moved": motion}, backward={"__state": A.gripper_state(gripper("binary"))}, final={"__raw": gripper("binary")},
        following={"__next": none if state is None else state},
    )
    opened = F.coalesce(F.col("__held"), -F.col("__moved"), F.lit(1.0)) / 2.0 + 0.5
    is_relative = any_of(lambda r: r.gripper is not None and r.gripper[0] == "relative")
    walked = walked.withColumn("__gripper", F.when(is_relative, opened).otherwise(F.coalesce("__state", "__raw")))

    empty = F.array().cast("array<double>")

    def at_place(piece_of: Callable[[Recipe], Piece | None]) -> Column:
        """One piece of each row's recipe. Slices and elements differ in numbers only, so each is written once."""
        of_kind = lambda kind, get: per_row(lambda r, s: get(piece_of(r), s) if isinstance(piece_of(r), kind) else None)
        source = of_kind((Cut, One), lambda p, s: s.vector(p.path))
        made = per_row(lambda r, s: piece_of(r)(s) if piece_of(r) is not None and not isinstance(piece_of(r), (Cut, One)) else None)
        out = empty if made is None else F.coalesce(made, empty)
        if any(isinstance(piece_of(r), One) for r, _ in by_layout.values()):
            x = F.get(source, F.when(of_kind(One, lambda p, s: p.i) < 0, F.size(source) + of_kind(One, lambda p, s: p.i)).otherwise(of_kind(One, lambda p, s: p.i)))
            x = F.when(of_kind(One, lambda p, s: p.clip), A.clip_gripper(x)).otherwise(x)
            x = F.when(of_kind(One, lambda p, s: p.flip), A.invert_gripper(x)).otherwise(x)
            out = F.when(any_of(lambda r: isinstance(piece_of(r), One)), F.array(x)).otherwise(out)
        if any(isinstance(piece_of(r), Cut) for r, _ in by_layout.values()):
            start, stop = of_kind(Cut, lambda p, s: p.start), of_kind(Cut, lambda p, s: p.stop if p.stop is not None else 1 << 30)
            size = F.size(source)
            low = F.greatest(F.when(start < 0, size + start).otherwise(start), F.lit(0))
            high = F.least(F.when(stop < 0, size + stop).otherwise(stop), size)
            out = F.when(any_of(lambda r: isinstance(piece_of(r), Cut)), F.slice(source, low + 1, F.greatest(high - low, F.lit(0)))).otherwise(out)
        return out

    def in_turn(pieces_of: Callable[[Recipe], Sequence[Piece]]) -> Column:
        """Concatenation of the pieces of each row's recipe, chosen place by place."""
        most = max(len(pieces_of(r)) for r, _ in by_layout.values())
        return F.concat(empty, *[at_place(lambda r, i=i: pieces_of(r)[i] if i < len(pieces_of(r)) else None) for i in range(most)])

    # a first step that is dropped, and a last one without a following state
    drops, reaches = any_of(lambda r: r.drop_first), any_of(lambda r: r.reached_state)
    kept = walked.filter(~(drops & (F.col("timestep") == 0)) & ~(reaches & F.col("__next").isNull()))
    plain = in_turn(lambda r: r.action or [whole("action")])
    if state is not None:
        moved = F.array(*[F.col("__next")[i] - state[i] for i in range(6)], V.at(F.col("__action"), -1))
    entries = []
    for i in range(max(len(r.fields) for r, _ in by_layout.values())):
        name = per_row(lambda r, s, i=i: list(r.fields)[i] if i < len(r.fields) else None)
        entries.append(F.struct(name.alias("name"), in_turn(lambda r, i=i: list(r.fields.values())[i] if i < len(r.fields) else ()).alias("values")))
    observation = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["name"].isNotNull())) if entries else F.create_map().cast("map<string,array<double>>")
    language = per_row(lambda r, s: r.language(s) if r.language is not None else None)
    said = F.col("language_instruction") if language is None else F.when(any_of(lambda r: r.language is not None), language).otherwise(F.col("language_instruction"))
    known_name = F.when(F.col("dataset_name").isin(names), F.col("dataset_name")).otherwise(F.raise_error(F.concat(F.lit("no recipe for dataset "), F.coalesce("dataset_name", F.lit("null")))))
    made = kept.withColumn("__action", plain)
    action = F.col("__action") if state is None else F.when(reaches, moved).otherwise(F.col("__action"))
    return made.select(
        known_name.alias("dataset_name"), "episode_id", (F.col("timestep") - drops.cast("int")).alias("timestep"), said.alias("language_instruction"), action.alias("action"),
        observation.alias("observation"),
    )
