"""Action columns: gripper conventions, discretization into token ids and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from armature.functions import vectors as V

# Fixed values of the discretization and label contracts.
BINS = 256
LOW, HIGH = -1.0, 1.0
VOCAB_SIZE = 32000
IGNORE_LABEL = -100
EMPTY_TOKEN = 29871


def invert_gripper(x: Column) -> Column:
    return 1.0 - x


def clip_gripper(x: Column) -> Column:
    return V.clip(x, 0.0, 1.0)


def gripper_state(x: Column) -> Column:
    """1 open, 0 closed, null in between."""
    return F.when(x > 0.95, 1.0).when(x < 0.05, 0.0)


def gripper_motion(x: Column) -> Column:
    """+1 opening, -1 closing, null for no motion, from a relative command that closes with positive values."""
    return F.when(x < -0.1, 1.0).when(x > 0.1, -1.0)


def bin_edge(i: Column) -> Column:
    """Lower edge of bin `i` (1-based), bit-equal to the i-th of 256 evenly spaced points, the last included."""
    return F.lit(LOW) + (i - 1) * F.lit((HIGH - LOW) / (BINS - 1))


def action_bin(x: Column) -> Column:
    """Bin 1..256 of a clipped action: the number of edges that are <= x.

    The closed form can be off by one when x sits exactly on an edge, so it is corrected against the two edges around.
    """
    clipped = V.clip(x, LOW, HIGH)
    guess = F.floor((clipped - LOW) * ((BINS - 1) / (HIGH - LOW))).cast("int") + 1
    up = F.least(guess + 1, F.lit(BINS))
    return (
        F.when(bin_edge(up) <= clipped, up)
        .when(bin_edge(guess) <= clipped, guess)
        .otherwise(guess - 1)
        .cast("int")
    )


def token_of_bin(b: Column, vocab: int = VOCAB_SIZE) -> Column:
    return (F.lit(vocab) - b).cast("int")


def action_of_token(token: Column, vocab: int = VOCAB_SIZE) -> Column:
    """Centre of the token's bin; the last bin shares the centre of the one before it."""
    i = F.greatest(F.lit(0), F.least(F.lit(BINS - 2), F.lit(vocab) - token - 1))
    left, right = bin_edge(i + 1), bin_edge(i + 2)
    return (left + right) / 2.0


def is_action_token(token: Column, vocab: int = VOCAB_SIZE) -> Column:
    return token > vocab - (BINS + 1)


def unnormalize(x: Column, q01: Column, q99: Column, mask: Column) -> Column:
    return F.when(F.coalesce(mask, F.lit(True)), 0.5 * (x + 1.0) * (q99 - q01) + q01).otherwise(x)


def environment_gripper(x: Column, binarize: bool = True, flip: bool = False) -> Column:
    """[0, 1] -> [-1, 1], optionally only its sign, optionally mirrored. `+ 0.0` turns -0.0 into 0.0."""
    y = 2.0 * x - 1.0
    if binarize:
        y = F.signum(y)
    return (-y if flip else y) + 0.0
