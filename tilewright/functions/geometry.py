"""A small polygon kernel on NumPy arrays: what Spark has no functions for.

A geometry is a list of polygons, a polygon a list of rings, a ring an array of vertices without the closing one.
"""

from __future__ import annotations

import struct

import numpy as np

Polygons = list[list[np.ndarray]]


def open_ring(ring: np.ndarray) -> np.ndarray:
    ring = np.asarray(ring, np.float64).reshape(-1, 2)
    return ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring


def parse(wkb: bytes) -> Polygons:
    """Polygon or MultiPolygon from WKB, either byte order; further dimensions are left out."""
    at = 0

    def read(kind: str, n: int = 1):
        nonlocal at
        out = struct.unpack_from(f"{order}{n}{kind}", wkb, at)
        at += struct.calcsize(f"{order}{n}{kind}")
        return out

    def polygon(dims: int) -> list[np.ndarray]:
        return [open_ring(np.array(read("d", n * dims)).reshape(n, dims)[:, :2]) for n in (read("I")[0] for _ in range(read("I")[0]))]

    def geometry() -> Polygons:
        nonlocal at, order
        order = "<" if wkb[at] == 1 else ">"
        at += 1
        kind = read("I")[0]
        flags, kind = kind & 0xE0000000, kind & 0x1FFFFFFF
        dims = 2 + bool(flags & 0x80000000) + bool(flags & 0x40000000) + (0, 1, 1, 2)[kind // 1000]
        if flags & 0x20000000:
            read("I")
        if kind % 1000 == 3:
            return [polygon(dims)]
        if kind % 1000 in (6, 7):
            return [p for _ in range(read("I")[0]) for p in geometry()]
        raise ValueError(f"WKB type {kind} is no area")

    order = "<"
    return geometry()


def write(polygons: Polygons) -> bytes:
    """WKB of a Polygon or MultiPolygon."""

    def polygon(rings: list[np.ndarray]) -> bytes:
        out = struct.pack("<BII", 1, 3, len(rings))
        for ring in rings:
            closed = np.vstack((ring, ring[:1]))
            out += struct.pack("<I", len(closed)) + closed.astype("<f8").tobytes()
        return out

    if len(polygons) == 1:
        return polygon(polygons[0])
    return struct.pack("<BII", 1, 6, len(polygons)) + b"".join(map(polygon, polygons))


def box(xmin: float, ymin: float, xmax: float, ymax: float) -> Polygons:
    return [[np.array([(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax)], np.float64)]]


def ring_area(ring: np.ndarray) -> float:
    if len(ring) < 3:
        return 0.0
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2


def area(polygons: Polygons) -> float:
    return sum(abs(ring_area(p[0])) - sum(abs(ring_area(r)) for r in p[1:]) for p in polygons)


def points(polygons: Polygons) -> int:
    """Vertices with the closing one of each ring."""
    return sum(len(r) + 1 for p in polygons for r in p)


def bounds(polygons: Polygons) -> tuple[float, float, float, float]:
    every = np.concatenate([p[0] for p in polygons])
    return (*every.min(axis=0), *every.max(axis=0))


#: Products of points and edges worked out at a time.
CHUNK = 1 << 20


def _ring_side(ring: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each point 1 inside, 0 on the border, -1 outside."""
    (ax, ay), (bx, by) = ring.T[:, :, None], np.roll(ring, -1, axis=0).T[:, :, None]
    out = np.empty(len(x), np.int8)
    step = max(1, CHUNK // max(len(ring), 1))
    for k in range(0, len(x), step):
        px, py = x[None, k : k + step], y[None, k : k + step]
        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        on = (cross == 0) & (np.minimum(ax, bx) <= px) & (px <= np.maximum(ax, bx)) & (np.minimum(ay, by) <= py) & (py <= np.maximum(ay, by))
        up, down = (ay <= py) & (by > py), (by <= py) & (ay > py)
        odd = (np.count_nonzero(up & (cross > 0), axis=0) + np.count_nonzero(down & (cross < 0), axis=0)) % 2
        out[k : k + step] = np.where(on.any(axis=0), 0, np.where(odd == 1, 1, -1))
    return out


def covers_each(polygons: Polygons, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether each point is inside or on a border of any of the polygons, overlapping or not."""
    out = np.zeros(len(x), bool)
    for shell, *holes in polygons:
        left = np.flatnonzero(~out)
        side = _ring_side(shell, x[left], y[left])
        inside = side >= 0
        for hole in holes:
            some = np.flatnonzero(inside & (side > 0))
            inside[some] = _ring_side(hole, x[left[some]], y[left[some]]) <= 0
        out[left[inside]] = True
    return out


def covers(polygons: Polygons, x: float, y: float) -> bool:
    """Whether the point is inside or on a border."""
    return bool(covers_each(polygons, np.array([x], np.float64), np.array([y], np.float64))[0])


def _half_plane(ring: np.ndarray, axis: int, at: float, sign: float) -> np.ndarray:
    """The part of a ring on one side of an axis-parallel line."""
    if not len(ring):
        return ring
    depth = sign * (ring[:, axis] - at)
    if (depth >= 0).all():
        return ring
    if (depth <= 0).all():
        return ring[:0]
    out = []
    for i in range(len(ring)):
        j = (i + 1) % len(ring)
        if depth[i] >= 0:
            out.append(ring[i])
        if (depth[i] > 0) != (depth[j] > 0) and depth[i] != 0 and depth[j] != 0:
            cut = ring[i] + (ring[j] - ring[i]) * (depth[i] / (depth[i] - depth[j]))
            cut[axis] = at
            out.append(cut)
    return np.array(out).reshape(-1, 2)


def clip(polygons: Polygons, xmin: float, ymin: float, xmax: float, ymax: float) -> Polygons:
    """What lies inside a box. Parts of a concave ring come back joined along the box's border, with no area there: for
    points on that border the result says nothing, for all others inside the box it is right."""
    out = []
    for rings in polygons:
        kept = []
        for ring in rings:
            for axis, at, sign in ((0, xmin, 1), (0, xmax, -1), (1, ymin, 1), (1, ymax, -1)):
                ring = _half_plane(ring, axis, at, sign)
            if len(ring):
                keep = (ring != np.roll(ring, 1, axis=0)).any(axis=1)
                ring = ring[keep]
            kept.append(ring)
        if abs(ring_area(kept[0])) > 0:
            out.append([kept[0], *(r for r in kept[1:] if abs(ring_area(r)) > 0)])
    return out


def fills(polygons: Polygons, xmin: float, ymin: float, xmax: float, ymax: float) -> bool:
    """Whether one polygon of a clip to the box has the box's whole area. Polygons that overlay.union() made are apart,
    so no two of them fill a box together; of others, a box that only several fill counts as not filled."""
    whole = (xmax - xmin) * (ymax - ymin)
    return any(area([p]) >= whole * (1 - 1e-12) for p in polygons)


def interior_point(polygons: Polygons) -> tuple[float, float]:
    """A point inside: the middle of the widest stretch on a horizontal line halfway between two vertex latitudes."""
    best = None
    for rings in polygons:
        y = np.unique(np.concatenate([r[:, 1] for r in rings]))
        if len(y) < 2:
            continue
        gap = np.diff(y)
        middle = (y[0] + y[-1]) / 2
        k = int(np.argmin(np.where(gap > 0, np.abs((y[:-1] + y[1:]) / 2 - middle), np.inf)))
        level = (y[k] + y[k + 1]) / 2
        cuts = []
        for r in rings:
            a, b = r, np.roll(r, -1, axis=0)
            cross = (a[:, 1] > level) != (b[:, 1] > level)
            a, b = a[cross], b[cross]
            cuts.append(a[:, 0] + (level - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0]))
        x = np.sort(np.concatenate(cuts))
        for left, right in zip(x[::2], x[1::2]):
            if best is None or right - left > best[0]:
                best = (right - left, (left + right) / 2, level)
    if best is None:
        raise ValueError("an area without inside has no interior point")
    return float(best[1]), float(best[2])


def merge(parts: list[Polygons]) -> Polygons:
    """Parts as one geometry. They stay as they are, overlapping or not: covers_each() holds where any of them covers.
    overlay.union() makes them one without inner edges."""
    return [p for part in parts for p in part]
