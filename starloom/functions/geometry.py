"""Shapes of NESTED pixels: corners, neighbours, outer borders, and the pixels that a cone or polygon meets.

Plain numpy over small lists of pixels: regions on the driver, tiles in tasks.
Positions are unit vectors.  The rows of a catalog are handled by the Column
functions of ``healpix``.
"""

from __future__ import annotations

import math

import numpy as np

# Fixed values of the projection: ring of each base pixel's lower corner in units of nside, and its longitude in units of pi / 4.
RING = np.array([2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4])
LONGITUDE = np.array([1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7])

# Directions in which the surroundings of a corner are probed, and the step in mean pixel sizes.
PROBES = 32
STEP = 0.01

# No pixel is narrower than this share of the mean pixel size.
NARROWEST = 0.4

# Levels below the size of a region at which its cover stops.
COVER_LEVELS = 5


def pixel_size(order: int) -> float:
    """Square root of a pixel's area, in radians."""
    return math.sqrt(4 * math.pi / 12) / (1 << order)


def unit_vector(ra, dec) -> np.ndarray:
    ra, dec = np.radians(ra), np.radians(dec)
    return np.stack([np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)], axis=-1)


def angle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Angles between unit vectors, exact for small ones."""
    return 2 * np.arcsin(np.minimum(1.0, np.linalg.norm(a - b, axis=-1) / 2))


def face_xy(order: int, pixel: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base pixel and column and row inside it."""
    pixel = np.asarray(pixel, np.int64)
    x, y = np.zeros_like(pixel), np.zeros_like(pixel)
    for bit in range(order):
        x |= (pixel >> (2 * bit) & 1) << bit
        y |= (pixel >> (2 * bit + 1) & 1) << bit
    return pixel >> (2 * order), x, y


def from_face_xy(order: int, face: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = face << (2 * order)
    for bit in range(order):
        out = out | (x >> bit & 1) << (2 * bit) | (y >> bit & 1) << (2 * bit + 1)
    return out


def position(order: int, face: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Unit vectors of points of a base pixel; ``x`` and ``y`` run from 0 to nside and need not be whole."""
    ns = float(1 << order)
    ring = RING[face] * ns - x - y
    north, south = ring < ns, ring > 3 * ns
    width = np.where(north, ring, np.where(south, 4 * ns - ring, ns))
    z = np.where(north, 1 - width**2 / (3 * ns * ns), np.where(south, width**2 / (3 * ns * ns) - 1, (2 * ns - ring) * 2 / (3 * ns)))
    # near a pole 1 - z is exact where z is not
    across = np.where(north | south, width / (ns * math.sqrt(3)) * np.sqrt(1 + np.abs(z)), np.sqrt(np.maximum(0.0, 1 - z * z)))
    phi = math.pi / 4 * (LONGITUDE[face] * width + x - y) / np.where(width > 0, width, 1.0)
    return np.stack([across * np.cos(phi), across * np.sin(phi), z], axis=-1)


def pixel_of(order: int, v: np.ndarray) -> np.ndarray:
    """Pixel numbers of unit vectors."""
    ns = 1 << order
    z, across = v[..., 2], np.hypot(v[..., 0], v[..., 1])
    turn = np.mod(np.arctan2(v[..., 1], v[..., 0]) / (math.pi / 2), 4.0)
    turn = np.where(turn >= 4.0, 0.0, turn)
    quarter = np.minimum(3, turn.astype(np.int64))
    belt = np.abs(z) <= 2 / 3
    up, down = np.floor(ns * (0.5 + turn - 0.75 * z)).astype(np.int64), np.floor(ns * (0.5 + turn + 0.75 * z)).astype(np.int64)
    reach = ns * across / np.sqrt((1 + np.abs(z)) / 3)
    p, m = (np.minimum(ns - 1, (t * reach).astype(np.int64)) for t in (turn - quarter, 1 - (turn - quarter)))
    fu, fd = up >> order, down >> order
    face = np.where(belt, np.where(fu == fd, (fu & 3) + 4, np.where(fu < fd, fu & 3, (fd & 3) + 8)), np.where(z > 0, quarter, quarter + 8))
    x = np.where(belt, down & (ns - 1), np.where(z > 0, ns - 1 - m, p))
    y = np.where(belt, ns - 1 - (up & (ns - 1)), np.where(z > 0, ns - 1 - p, m))
    return from_face_xy(order, face, x, y)


def vertices(order: int, pixel: np.ndarray, steps: int = 1) -> np.ndarray:
    """Points around the border of each pixel, ``steps`` per side, from the southern corner; shape (pixels, 4 * steps, 3)."""
    face, x, y = face_xy(order, pixel)
    t = np.arange(steps) / steps
    dx = np.concatenate([t, np.ones(steps), 1 - t, np.zeros(steps)])
    dy = np.concatenate([np.zeros(steps), t, np.ones(steps), 1 - t])
    return position(order, face[:, None] + np.zeros(4 * steps, np.int64), x[:, None] + dx, y[:, None] + dy)


def centers(order: int, pixel: np.ndarray) -> np.ndarray:
    face, x, y = face_xy(order, pixel)
    return position(order, face, x + 0.5, y + 0.5)


def neighbours(order: int, pixel: np.ndarray) -> np.ndarray:
    """Pixels that share a side or a corner: rows (index into ``pixel``, neighbour), each once.

    All pixels around a corner are met by a small circle around it.
    """
    pixel = np.asarray(pixel, np.int64)
    v = vertices(order, pixel).reshape(-1, 3)
    other = np.where(np.abs(v[:, 2:]) < 0.9, [[0.0, 0.0, 1.0]], [[1.0, 0.0, 0.0]])
    e1 = np.cross(other, v)
    e1 /= np.linalg.norm(e1, axis=1, keepdims=True)
    e2, turn = np.cross(v, e1), 2 * math.pi * (np.arange(PROBES) + 0.37) / PROBES
    around = v[:, None] + STEP * pixel_size(order) * (np.cos(turn)[:, None] * e1[:, None] + np.sin(turn)[:, None] * e2[:, None])
    met = pixel_of(order, around / np.linalg.norm(around, axis=-1, keepdims=True)).reshape(len(pixel), -1)
    pairs = np.unique(np.stack([np.repeat(np.arange(len(pixel)), met.shape[1]), met.ravel()], axis=1), axis=0)
    return pairs[pairs[:, 1] != pixel[pairs[:, 0]]]


def outer_border(order: int, pixel: int, at: int) -> np.ndarray:
    """Pixels of order ``at`` outside a pixel that touch it, in ascending order."""
    side, base = 1 << (at - order), pixel << (2 * (at - order))
    run = np.arange(side)
    edge = np.unique(np.concatenate([np.stack(p, axis=1) for p in ((run, 0 * run), (run, 0 * run + side - 1), (0 * run, run), (0 * run + side - 1, run))]), axis=0)
    inside = base + from_face_xy(at - order, np.zeros(len(edge), np.int64), edge[:, 0], edge[:, 1])
    met = np.unique(neighbours(at, inside)[:, 1])
    return met[met >> (2 * (at - order)) != pixel]


def margin_order(threshold_arcsec: float) -> int:
    """The finest order whose pixels are nowhere narrower than the threshold."""
    width = math.radians(threshold_arcsec / 3600)
    if width <= 0 or width > NARROWEST * pixel_size(0):
        raise ValueError("the threshold must be positive and smaller than a base pixel")
    return min(24, int(math.floor(math.log2(NARROWEST * pixel_size(0) / width))))


def descend(reach, least_size: float, max_order: int) -> list[tuple[int, int]]:
    """Pixels (order, number) that cover a region, coarse where they lie inside it.

    ``reach(centers, bounds)`` says for circles around pixels whether they may
    meet the region and whether they lie inside.  Pixels on its border are split
    until they are smaller than ``least_size``.
    """
    order, live, out = 0, np.arange(12), []
    while len(live):
        bound = angle(vertices(order, live, 2), centers(order, live)[:, None]).max(axis=1) * 1.1
        meets, inside = reach(centers(order, live), bound)
        last = order == max_order or pixel_size(order) <= least_size
        done = inside | (meets & last)
        out += [(order, int(p)) for p in live[done]]
        live = live[meets & ~done]
        live = (live[:, None] * 4 + np.arange(4)).ravel()
        order += 1
    return out


def cone_cover(ra: float, dec: float, radius_arcsec: float, max_order: int = 24) -> list[tuple[int, int]]:
    """Pixels that together hold every point of a cone."""
    v, r = unit_vector(ra, dec), math.radians(radius_arcsec / 3600)

    def reach(c, bound):
        d = angle(c, v)
        return d <= r + bound, d + bound <= r

    return descend(reach, r / (1 << COVER_LEVELS - 2), max_order)


def cone_tiles(ra: float, dec: float, radius_arcsec: float, order: int) -> list[int]:
    """Numbers of the pixels of one order that a cone meets.

    Borders are taken at 256 points a side, so a tile is missed only if the cone
    enters it by less than some 1e-5 of the tile's size.
    """
    v, r = unit_vector(ra, dec), math.radians(radius_arcsec / 3600)

    def reach(c, bound):
        d = angle(c, v)
        return d <= r + bound, np.zeros(len(c), bool)

    found = np.array([p for _, p in descend(reach, 0.0, order)], np.int64)
    home = int(pixel_of(order, v))
    out = []
    for part in np.array_split(found, max(1, len(found) // 500)):
        near = angle(vertices(order, part, 256), v).min(axis=1) if len(part) else np.zeros(0)
        out += part[(near <= r) | (part == home)].tolist()
    return sorted(out)


def polygon_cover(points: list[tuple[float, float]], max_order: int = 24) -> list[tuple[int, int]]:
    """Pixels that together hold every point of a convex polygon of (ra, dec) corners in either sense of rotation."""
    v = unit_vector(*np.array(points, float).T)
    normal = np.cross(v, np.roll(v, -1, axis=0))
    normal = normal / np.linalg.norm(normal, axis=1, keepdims=True)
    middle = v.sum(axis=0)
    if (normal @ middle).sum() < 0:
        normal = -normal
    size = angle(v, middle / np.linalg.norm(middle)).max()

    def reach(c, bound):
        depth = np.arcsin(np.clip(c @ normal.T, -1, 1))
        return (depth >= -bound[:, None]).all(axis=1), (depth >= bound[:, None]).all(axis=1)

    return descend(reach, size / (1 << COVER_LEVELS - 1), max_order)
