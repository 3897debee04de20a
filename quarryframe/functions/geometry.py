"""Geometry as columns. Matrices are row-major `array<double>` (3x3: 9, 4x4: 16)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def back_project(u: Column, v: Column, z: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> Column:
    """Camera point of a pixel; NULL where the depth is no finite positive number."""
    point = F.struct(((u - cx) * z / fx).alias("x"), ((v - cy) * z / fy).alias("y"), z.alias("z"))
    return F.when(valid_depth(z), point)


def valid_depth(z: Column) -> Column:
    return F.coalesce(~F.isnan(z) & (z > 0) & (z < float("inf")), F.lit(False))


def clean_depth(z: Column, far: float, far_is_valid: bool = False) -> Column:
    """Depths under 1 mm, beyond `far` (or at it, unless far_is_valid), NaN and NULL become 0."""
    beyond = z > far if far_is_valid else z >= far
    return F.when(z.isNull() | F.isnan(z) | (z < 0.001) | beyond, 0.0).otherwise(z)


def confident_depth(z: Column, confidence: Column, least: float = 0.5) -> Column:
    return F.when(confidence < least, 0.0).otherwise(z)


def project(point: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> Column:
    return F.struct((point["x"] * fx / point["z"] + cx).alias("u"), (point["y"] * fy / point["z"] + cy).alias("v"))


def rotation_angle_deg(a: Column, b: Column) -> Column:
    """Geodesic angle of two rotations: acos((trace(a b^T) - 1) / 2), the cosine clipped to [-1, 1]."""
    trace = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.degrees(F.acos(F.least(F.greatest((trace - 1) / 2, F.lit(-1.0)), F.lit(1.0))))


def transform_point(m: Column, x: Column, y: Column, z: Column, direction: bool = False) -> Column:
    """4x4 times a point (or a direction: without the translation)."""
    row = lambda i: m[4 * i] * x + m[4 * i + 1] * y + m[4 * i + 2] * z + (0 if direction else m[4 * i + 3])
    return F.struct(row(0).alias("x"), row(1).alias("y"), row(2).alias("z"))


def matmul4(a: Column, b: Column) -> Column:
    return F.array(*[sum((a[4 * i + k] * b[4 * k + j] for k in range(1, 4)), a[4 * i] * b[j]) for i in range(4) for j in range(4)])


def rigid_inverse(m: Column) -> Column:
    """Inverse of a rigid 4x4: rotation transposed, translation -R^T t."""
    rows = []
    for i in range(3):
        rows += [m[i], m[4 + i], m[8 + i], -(m[i] * m[3] + m[4 + i] * m[7] + m[8 + i] * m[11])]
    return F.array(*rows, *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])


def pose_delta(before: Column, now: Column) -> Column:
    """Motion from `before` to `now`: now * before^-1."""
    return matmul4(now, rigid_inverse(before))


def quaternion_to_matrix(w: Column, x: Column, y: Column, z: Column) -> Column:
    n = w * w + x * x + y * y + z * z
    s = F.when(n > 0, 2.0 / n).otherwise(0.0)
    return F.array(
        1 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w),
        s * (x * y + z * w), 1 - s * (x * x + z * z), s * (y * z - x * w),
        s * (x * z - y * w), s * (y * z + x * w), 1 - s * (x * x + y * y),
    )


def focal_from_fov(fov_rad: Column, size: Column) -> Column:
    return size / (2 * F.tan(fov_rad / 2))


def fov_from_focal(focal: Column, size: Column) -> Column:
    return 2 * F.atan(size / (2 * focal))


def heuristic_focal(width: Column, height: Column) -> Column:
    return 1.2 * F.greatest(width, height)


def cosine_distance(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, t: s + t)
    return 1 - dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def tracking_score(iou: Column, underfill: Column, overflow: Column, rmse_norm: Column, cd_norm: Column, rotation_deg: Column, shift_norm: Column) -> Column:
    return iou - 0.7 * underfill - 0.3 * overflow - 0.5 * rmse_norm - 1.0 * cd_norm - 0.3 * (rotation_deg / 10 + shift_norm)


def voxel_key(x: Column, y: Column, z: Column, size: float) -> Column:
    return F.struct(*[F.floor(c / size).alias(n) for c, n in ((x, "i"), (y, "j"), (z, "k"))])


def voxel_grid(x: Column, cells: int = 64) -> Column:
    """Cell of a coordinate in [-0.5, 0.5] (clamped a little inside) on a grid."""
    return F.floor((F.least(F.greatest(x, F.lit(-0.5 + 1e-6)), F.lit(0.5 - 1e-6)) + 0.5) * cells).cast("int")


def min_max_scaled(z: Column, low: Column, high: Column) -> Column:
    """To [-1, 1]; a constant series gives -1."""
    return F.when(high > low, (z - low) / (high - low)).otherwise(0.0) * 2 - 1


def radical_inverse(base: int, n: Column, digits: int = 40) -> Column:
    """Digits of n mirrored at the radix point."""
    digits = min(digits, max(1, math.floor(62 / math.log2(base))))
    terms = [F.pmod(F.floor(n / F.lit(base**i)), F.lit(base)) / F.lit(float(base ** (i + 1))) for i in range(digits)]
    return sum(terms[1:], terms[0])


def hammersley_sphere(i: Column, n: int, offset_u: float = 0.0, offset_v: float = 0.0) -> Column:
    """(yaw, pitch) of the i-th of n points on the sphere. The first quarter of the sequence covers half of the heights."""
    u, v = i / F.lit(float(n)) + offset_u / n, radical_inverse(2, i) + offset_v
    u = F.when(u < 0.25, 2 * u).otherwise(u * (2 / 3) + 1 / 3)
    return F.struct((v * 2 * math.pi).alias("yaw"), (F.acos(F.greatest(1 - 2 * u, F.lit(-1.0))) - math.pi / 2).alias("pitch"))


def point_grid(side: int) -> Column:
    """Array of (x, y) evenly spaced in the unit square, row by row."""
    place = lambda k: (k + 0.5) / F.lit(float(side))
    line = F.sequence(F.lit(0), F.lit(side - 1))
    return F.flatten(F.transform(line, lambda r: F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda c: F.struct(place(c).alias("x"), place(r).alias("y")))))


def layered_point_grids(side: int, layers: int, scale: int) -> list[Column]:
    return [point_grid(int(side / scale**k)) for k in range(layers + 1)]


def crop_boxes(width: Column, height: Column, layers: int, overlap_share: float) -> Column:
    """Array of (layer, x0, y0, x1, y1): the whole image, then 2^k by 2^k overlapping crops for each layer k."""
    box = lambda layer, x0, y0, x1, y1: F.struct(F.lit(layer).alias("layer"), *[v.cast("long").alias(k) for k, v in (("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1))])
    out = [box(0, F.lit(0), F.lit(0), width, height)]
    for layer in range(1, layers + 1):
        n = 2**layer
        overlap = F.floor(F.least(width, height) * F.lit(overlap_share) * (2 / n))
        w, h = (F.ceil((overlap * (n - 1) + side) / n) for side in (width, height))
        out += [box(layer, (w - overlap) * i, (h - overlap) * j, F.least((w - overlap) * i + w, width), F.least((h - overlap) * j + h, height)) for i in range(n) for j in range(n)]
    return F.array(*out)


def closest_tiling(aspect: Column, most: int, area: Column | None = None, side: int = 448) -> Column:
    """(w, h) tiles, w * h <= most, whose ratio is closest to the aspect; of ratios equally close the first in order of tiles; with an
    area the last one, whatever its ratio, of whose tiles the area exceeds half."""
    grid = sorted(((w, h) for w in range(1, most + 1) for h in range(1, most + 1) if w * h <= most), key=lambda x: (x[0] * x[1], x))
    tiles = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(h).alias("h")) for w, h in grid])
    off = lambda g: F.abs(aspect - g["w"] / g["h"])
    nearest = F.filter(tiles, lambda g: off(g) <= F.array_min(F.transform(tiles, off)))
    first = F.get(nearest, F.lit(0))
    if area is None:
        return first
    large = F.filter(nearest, lambda g: area > 0.5 * side * side * g["w"] * g["h"])
    return F.coalesce(F.get(large, F.size(large) - 1), first)


def box_iou(ax: Column, ay: Column, aw: Column, ah: Column, bx: Column, by: Column, bw: Column, bh: Column) -> Column:
    """IoU of x, y, width, height boxes; 0 if the union is empty."""
    w = F.greatest(F.least(ax + aw, bx + bw) - F.greatest(ax, bx), F.lit(0.0))
    h = F.greatest(F.least(ay + ah, by + bh) - F.greatest(ay, by), F.lit(0.0))
    union = aw * ah + bw * bh - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


def xyxy_to_xywh(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.alias("x"), y0.alias("y"), (x1 - x0).alias("w"), (y1 - y0).alias("h"))


def padded_box(x: Column, y: Column, w: Column, h: Column, share: float, width: Column, height: Column) -> Column:
    """A box widened by a share of its own size (a pixel at least) on each side, clamped to the image."""
    px, py = F.greatest(F.floor(w * share), F.lit(1)), F.greatest(F.floor(h * share), F.lit(1))
    return F.struct(
        F.greatest(x - px, F.lit(0)).alias("x0"), F.greatest(y - py, F.lit(0)).alias("y0"), F.least(x + w + px, width).alias("x1"), F.least(y + h + py, height).alias("y1")
    )


def near_crop_edge(x0: Column, y0: Column, x1: Column, y1: Column, crop: Column, image: Column, tolerance: float = 20.0) -> Column:
    """A side lies within the tolerance of the crop's side and not of the image's."""
    near = [(F.abs(a - crop[k]) <= tolerance) & (F.abs(a - image[k]) > tolerance) for a, k in ((x0, "x0"), (y0, "y0"), (x1, "x1"), (y1, "y1"))]
    return near[0] | near[1] | near[2] | near[3]
