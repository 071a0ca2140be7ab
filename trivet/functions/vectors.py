"""3-D vector, box and transform expressions. A vector is a triple of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]


def minus(a: Vector, b: Vector) -> Vector:
    return tuple(x - y for x, y in zip(a, b, strict=True))


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def distance(a: Vector, b: Vector) -> Column:
    return norm(minus(a, b))


def normalized(a: Vector) -> Vector:
    """The unit vector; a zero vector is an error."""
    n = norm(a)
    return tuple(F.when(n > 0, x / n).otherwise(F.raise_error(F.lit("cannot normalise a zero vector")).cast("double")) for x in a)


def scale_about(p: Vector, factor: Column, origin: Vector) -> Vector:
    """o + s (p - o) on each axis."""
    return tuple(o + factor * (x - o) for x, o in zip(p, origin, strict=True))


def transform_point(matrix: Sequence[Sequence[float]], p: Vector) -> Vector:
    """A 4x4 homogeneous transform with division by w; w = 0 is an error."""
    rows = [F.lit(float(r[0])) * p[0] + F.lit(float(r[1])) * p[1] + F.lit(float(r[2])) * p[2] + F.lit(float(r[3])) for r in matrix]
    w = rows[3]
    return tuple(F.when(w != 0, x / w).otherwise(F.raise_error(F.lit("homogeneous w is zero")).cast("double")) for x in rows[:3])


def identity() -> list[list[float]]:
    return [[float(i == j) for j in range(4)] for i in range(4)]


def uniform_scale(s: float) -> list[list[float]]:
    if not s > 0:
        raise ValueError("a scale must be above 0")
    return [[float(s) if i == j < 3 else float(i == j) for j in range(4)] for i in range(4)]


def translation(dx: float, dy: float, dz: float) -> list[list[float]]:
    m = identity()
    for row, d in zip(m, (dx, dy, dz), strict=False):
        row[3] = float(d)
    return m


def box_measures(low: Vector, high: Vector) -> dict[str, Column]:
    """width, depth, height, volume and center of a box; min above max is an error."""
    ok = (low[0] <= high[0]) & (low[1] <= high[1]) & (low[2] <= high[2])
    size = [F.when(ok, h - x).otherwise(F.raise_error(F.lit("a box has min above max")).cast("double")) for x, h in zip(low, high, strict=True)]
    out = dict(zip(("width", "depth", "height"), size, strict=True))
    out["volume"] = size[0] * size[1] * size[2]
    out |= {f"center_{a}": (x + h) / 2 for a, x, h in zip("xyz", low, high, strict=True)}
    return out


def not_finite(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) == float("inf"))
