"""Sequence operators over the steps of an episode: grippers, reached-state relabeling, no-ops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.functions import vectors as V
from armature.operators.episodes import (
    EPISODE,
    SEGMENT_ROWS,
    segment_of,
    with_scans,
    with_timestep,
)
from armature.operators.ordering import with_position


def binarize_gripper(df: DataFrame, gripper: Column, name: str = "gripper", keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS) -> DataFrame:
    """In-between values take the open / closed state reached after them; a trailing run keeps the raw last value.

    Both come from one backward scan and the raw value of the last step.
    """
    found = with_scans(df, backward={"__state": A.gripper_state(gripper)}, final={"__raw": gripper}, keys=keys, rows=rows)
    return found.withColumn(name, F.coalesce("__state", "__raw")).drop("__state", "__raw")


def absolute_gripper(df: DataFrame, relative: Column, name: str = "gripper", keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Relative open / close commands -> 1 open, 0 closed. Before the first command the state is its opposite."""
    motion = A.gripper_motion(relative)
    held = with_scans(df, forward={"__held": motion}, first={"__first": motion}, keys=keys, rows=rows)
    state = F.coalesce(F.col("__held"), -F.col("__first"), F.lit(1.0))
    return held.withColumn(name, state / 2.0 + 0.5).drop("__held", "__first")


def drop_first_step(df: DataFrame) -> DataFrame:
    """Steps are numbered without gaps, so renumbering is a subtraction."""
    return with_timestep(df.filter(F.col("timestep") > 0), F.col("timestep") - 1)


def relabel_by_reached_state(
    df: DataFrame, state: Column, action: str = "action", moves: int = 6, keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Replace the motion part of the action by the state change that followed; the last step has none and is dropped."""
    named = df.withColumn("__state", V.doubles(state))
    ahead = with_scans(named, following={"__next": F.col("__state")}, keys=keys, rows=rows).filter(F.col("__next").isNotNull())
    moved = [F.col("__next")[i] - F.col("__state")[i] for i in range(moves)]
    return ahead.withColumn(action, F.array(*moved, V.at(action, -1))).drop("__state", "__next")


def mark_noops(
    df: DataFrame, small: Column, gripper: str, keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Add `is_noop`: a step that barely moves and keeps the gripper of the last kept step.

    Dropped steps share the gripper of the kept step before them, so the raw predecessor's gripper is the kept one's;
    before the first real motion nothing is kept and only the motion counts.
    """
    # the first real motion is at or before a step if a scan so far has met one
    marked = df.withColumn("__small", small)
    met = F.when(~F.col("__small"), F.col("timestep"))
    found = with_scans(marked, forward={"__met": met}, preceding={"__before": F.col(gripper)}, keys=keys, rows=rows)
    changed = (F.col("__met") < F.col("timestep")) & (F.col(gripper) != F.col("__before"))
    return found.withColumn("is_noop", F.col("__small") & ~F.coalesce(changed, F.lit(False))).drop("__small", "__met", "__before")


def without_noops(df: DataFrame, keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Drop marked steps and renumber the rest as `demo_step`."""
    kept = df.filter(~F.col("is_noop")).drop("is_noop")
    numbered = with_position(kept, keys, ["timestep"], segment_of(F.col("timestep"), rows), "demo_step")
    return numbered.withColumn("demo_step", F.col("demo_step").cast("int"))
