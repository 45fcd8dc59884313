"""Rotations as column arithmetic. Angles are radians, quaternions are (x, y, z, w), matrices are 3x3 lists of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Matrix = list[list[Column]]


def euler_to_matrix(roll: Column, pitch: Column, yaw: Column) -> Matrix:
    """Rotation about x, then y, then z."""
    sx, cx = F.sin(roll), F.cos(roll)
    sy, cy = F.sin(pitch), F.cos(pitch)
    sz, cz = F.sin(yaw), F.cos(yaw)
    return [
        [cy * cz, sx * sy * cz - cx * sz, cx * sy * cz + sx * sz],
        [cy * sz, sx * sy * sz + cx * cz, cx * sy * sz - sx * cz],
        [-sy, sx * cy, cx * cy],
    ]


def transpose(m: Matrix) -> Matrix:
    """Also the inverse, for a rotation."""
    return [[m[r][c] for r in range(3)] for c in range(3)]


def multiply(a: Matrix, b: Matrix) -> Matrix:
    return [[a[r][0] * b[0][c] + a[r][1] * b[1][c] + a[r][2] * b[2][c] for c in range(3)] for r in range(3)]


def apply(m: Matrix, v: list[Column]) -> list[Column]:
    return [m[r][0] * v[0] + m[r][1] * v[1] + m[r][2] * v[2] for r in range(3)]


def quaternion_to_euler(x: Column, y: Column, z: Column, w: Column) -> list[Column]:
    """Roll, pitch, yaw. At the poles (|sin pitch| = 1) yaw is 0 and roll takes the whole remaining turn."""
    two_over_norm = 2.0 / (x * x + y * y + z * z + w * w)
    r00 = 1.0 - (y * y + z * z) * two_over_norm
    r10 = (x * y + z * w) * two_over_norm
    r20 = (x * z - y * w) * two_over_norm
    r21 = (y * z + x * w) * two_over_norm
    r22 = 1.0 - (x * x + y * y) * two_over_norm
    r01 = (x * y - z * w) * two_over_norm
    r02 = (x * z + y * w) * two_over_norm
    pole = F.abs(r20) >= F.lit(1.0 - 1e-9)
    sign = F.when(r20 < 0, 1.0).otherwise(-1.0)
    pitch = -F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r20)))
    roll = F.when(pole, F.atan2(sign * r01, sign * r02)).otherwise(F.atan2(r21, r22))
    yaw = F.when(pole, F.lit(0.0)).otherwise(F.atan2(r10, r00))
    return [roll, pitch, yaw]


def quaternion_to_axis_angle(x: Column, y: Column, z: Column, w: Column) -> list[Column]:
    """Axis times angle; zero when the scalar part is exactly +-1 after clipping."""
    scalar = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), w))
    den = F.sqrt(1.0 - scalar * scalar)
    return [F.when(den == 0, 0.0).otherwise(v * 2.0 * F.acos(scalar) / F.nullif(den, F.lit(0.0))) for v in (x, y, z)]


def velocity_in_wrist_frame(velocity: list[Column], wrist_angles: list[Column]) -> list[Column]:
    """Base-frame twist (3 linear + 3 Euler) seen from the wrist: 3 linear + first two rows of the rotation."""
    frame = euler_to_matrix(*wrist_angles)
    back = transpose(frame)
    turn = multiply(back, multiply(euler_to_matrix(*velocity[3:6]), frame))
    return apply(back, velocity[0:3]) + turn[0] + turn[1]
