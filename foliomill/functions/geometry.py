"""Boxes (x1, y1, x2, y2), polygons (arrays of points) and 3 x 3 matrices as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def box_valid(box: Column, width: Column, height: Column) -> Column:
    inside = (box[0] >= 0) & (box[0] < box[2]) & (box[2] <= width) & (box[1] >= 0) & (box[1] < box[3]) & (box[3] <= height)
    return F.coalesce((F.size(box) == 4) & inside, F.lit(False))


def boxes_intersect(a: Column, b: Column) -> Column:
    return (F.greatest(a[0], b[0]) < F.least(a[2], b[2])) & (F.greatest(a[1], b[1]) < F.least(a[3], b[3]))


def area(box: Column) -> Column:
    return (box[2] - box[0]) * (box[3] - box[1])


def overlap_ratio(a: Column, b: Column) -> Column:
    """Common area over the smaller area; 0 if they don't intersect or the smaller one has no area."""
    common = (F.least(a[2], b[2]) - F.greatest(a[0], b[0])) * (F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    return F.when(boxes_intersect(a, b) & (F.least(area(a), area(b)) > 0), common / F.least(area(a), area(b))).otherwise(0.0)


def contains(outer: Column, inner: Column, slack: float = 0) -> Column:
    return (inner[0] >= outer[0] - slack) & (inner[1] >= outer[1] - slack) & (inner[2] <= outer[2] + slack) & (inner[3] <= outer[3] + slack)


def polygon_inside(polygon: Column, width: Column, height: Column) -> Column:
    return F.forall(polygon, lambda p: (p[0] >= 0) & (p[0] <= width) & (p[1] >= 0) & (p[1] <= height))


def bounds(polygon: Column) -> Column:
    x, y = F.transform(polygon, lambda p: p[0]), F.transform(polygon, lambda p: p[1])
    return F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y))


def polygons_intersect(a: Column, b: Column, tolerance: float = 0.5) -> Column:
    """Separating axes of convex polygons: they share an area if on each edge's normal their shadows overlap by more than tolerance."""

    def normals(polygon: Column) -> Column:
        following = F.concat(F.slice(polygon, 2, F.size(polygon)), F.slice(polygon, 1, 1))
        return F.zip_with(polygon, following, lambda p, q: F.array(p[1] - q[1], q[0] - p[0]))

    def shadow(polygon: Column, n: Column) -> Column:
        return F.transform(polygon, lambda p: p[0] * n[0] + p[1] * n[1])

    def overlaps(n: Column) -> Column:
        u, v = shadow(a, n), shadow(b, n)
        return F.least(F.array_max(u), F.array_max(v)) - F.greatest(F.array_min(u), F.array_min(v)) > tolerance

    return F.coalesce((F.size(a) >= 3) & (F.size(b) >= 3) & F.forall(F.concat(normals(a), normals(b)), overlaps), F.lit(False))


def inverse_holds(forward: Column, inverse: Column, tolerance: float = 1e-5) -> Column:
    """Whether two 3 x 3 matrices multiply to the identity."""
    def entry(i: int, j: int) -> Column:
        return forward[i][0] * inverse[0][j] + forward[i][1] * inverse[1][j] + forward[i][2] * inverse[2][j]

    good = F.lit(True)
    for i in range(3):
        for j in range(3):
            one = float(i == j)
            good = good & (F.abs(entry(i, j) - one) <= tolerance + 1e-5 * one)
    shaped = (F.size(forward) == 3) & (F.size(inverse) == 3) & F.forall(forward, lambda r: F.size(r) == 3) & F.forall(inverse, lambda r: F.size(r) == 3)
    return F.coalesce(F.when(shaped, good).otherwise(False), F.lit(False))


def homography(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The projective map that takes four points to four points."""
    rows, right = [], []
    for (x, y), (u, v) in zip(source, target, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    return np.append(np.linalg.solve(np.array(rows, float), np.array(right, float)), 1.0).reshape(3, 3)


@F.pandas_udf(ArrayType(ArrayType(DoubleType())))
def moved(polygon: pd.Series, matrix: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Polygon under a 3 x 3 matrix, kept inside the page."""
    def one(points, m, w, h):
        if points is None or m is None:
            return None
        p = np.column_stack([np.stack(points).astype(float), np.ones(len(points))]) @ np.stack(m).astype(float).T
        return np.clip(p[:, :2] / p[:, 2:], 0, [w - 1, h - 1]).tolist()

    return pd.Series([one(*x) for x in zip(polygon, matrix, width, height, strict=True)])
