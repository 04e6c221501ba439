"""Geometry of batches of polygons in numpy, called through Arrow: what has too many cases for columns.

A batch is held as coordinates (n, m) padded on the right and the number of vertices of each row. Null
and empty polygons have no vertices, area 0 and no overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Polygons:
    def __init__(self, x: np.ndarray, y: np.ndarray, n: np.ndarray):
        self.x, self.y, self.n = x, y, n

    @classmethod
    def of(cls, column: pa.Array) -> Polygons:
        """From lists of (x, y) structs; a polygon with a null coordinate counts as none."""
        n = np.asarray(column.value_lengths().fill_null(0), np.int64)
        flat = column.flatten()
        x, y = (np.asarray(flat.field(k).to_numpy(zero_copy_only=False), np.float64) for k in (0, 1))
        room = max(4, int(n.max(initial=0)))
        out = cls(np.zeros((len(n), room)), np.zeros((len(n), room)), n)
        held = np.arange(room) < n[:, None]
        out.x[held], out.y[held] = x, y
        return out

    def take(self, rows: np.ndarray) -> Polygons:
        return Polygons(self.x[rows], self.y[rows], self.n[rows])

    def envelopes(self) -> tuple[np.ndarray, ...]:
        """x0, y0, x1, y1; polygons without vertices have one that meets nothing."""
        held = np.arange(self.x.shape[1]) < self.n[:, None]
        return tuple(np.where(held, v, end * np.inf).min(1) if end > 0 else np.where(held, v, end * np.inf).max(1) for end in (1, -1) for v in (self.x, self.y))

    def lists(self, ok: np.ndarray) -> pa.Array:
        """Lists of structs, null where not `ok`."""
        held = (np.arange(self.x.shape[1]) < self.n[:, None]) & ok[:, None]
        points = pa.StructArray.from_arrays([pa.array(self.x[held]), pa.array(self.y[held])], ["x", "y"])
        offsets = np.concatenate([[0], np.cumsum(held.sum(1))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), points, mask=pa.array(~ok))

    def following(self, values: np.ndarray) -> np.ndarray:
        """Of each vertex the value of the next one around."""
        at = np.arange(values.shape[1])
        return np.take_along_axis(values, np.where(at + 1 < self.n[:, None], at + 1, 0), 1)

    def signed_area(self) -> np.ndarray:
        cross = self.x * self.following(self.y) - self.following(self.x) * self.y
        cross = np.where(np.arange(self.x.shape[1]) < self.n[:, None], cross, 0.0)
        # Edge by edge: numpy's sum of eight columns or more has another order, so a row's last bits would depend on its batch.
        out = np.zeros(len(cross))
        for k in range(cross.shape[1]):
            out += cross[:, k]
        return out / 2

    def area(self) -> np.ndarray:
        return np.where(self.n >= 3, np.abs(self.signed_area()), 0.0)

    def clip(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> Polygons:
        """The parts of convex polygons where a x + b y + c >= 0."""
        side = a[:, None] * self.x + b[:, None] * self.y + c[:, None]
        held = np.arange(self.x.shape[1]) < self.n[:, None]
        after = self.following(side)
        inside, crossing = (side >= 0) & held, ((side >= 0) != (after >= 0)) & held
        share = np.divide(side, side - after, out=np.zeros_like(side), where=crossing)
        keep = np.stack([inside, crossing], 2).reshape(len(side), 2 * side.shape[1])
        n = keep.sum(1)
        out = Polygons(np.zeros((len(n), max(4, int(n.max(initial=0))))), np.zeros((len(n), max(4, int(n.max(initial=0))))), n)
        row, at = np.nonzero(keep)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        for mine, name in ((self.x, "x"), (self.y, "y")):
            both = np.stack([mine, mine + (self.following(mine) - mine) * share], 2).reshape(len(side), 2 * side.shape[1])
            getattr(out, name)[row, place] = both[row, at]
        return out

    def within(self, other: Polygons) -> Polygons:
        """The intersections with convex quadrilaterals of either winding; none with other shapes."""
        out, turn = Polygons(self.x, self.y, np.where(other.n == 4, self.n, 0)), np.sign(other.signed_area())
        for k in range(4):
            px, py, qx, qy = other.x[:, k], other.y[:, k], other.x[:, (k + 1) % 4], other.y[:, (k + 1) % 4]
            a, b = turn * (py - qy), turn * (qx - px)
            out = out.clip(a, b, -(a * px + b * py))
        return out

    def in_rectangle(self, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> Polygons:
        one, none = np.ones(len(self.n)), np.zeros(len(self.n))
        return self.clip(one, none, -x0).clip(-one, none, x1).clip(none, one, -y0).clip(none, -one, y1)


def _overlaps(first: pa.Array, second: pa.Array) -> pa.Array:
    p, q = Polygons.of(first), Polygons.of(second)
    a, b = p.area(), q.area()
    # A box and its own label are most pairs: only others are clipped.
    same = (p.n == 4) & (q.n == 4) & (p.x[:, :4] == q.x[:, :4]).all(1) & (p.y[:, :4] == q.y[:, :4]).all(1)
    inter, other = a.copy(), np.flatnonzero(~same)
    inter[other] = p.take(other).within(q.take(other)).area()
    return pa.StructArray.from_arrays([pa.array(inter), pa.array(a), pa.array(b)], ["inter", "a", "b"])


def _shares(poly: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    p = Polygons.of(poly)
    rect = [np.asarray(v, np.float64) for v in (x0, y0, x1, y1)]
    out, quad = np.zeros(len(p.n)), p.n == 4
    x, y = p.x[:, :4], p.y[:, :4]
    size = np.abs((x[:, 0] - x[:, 2]) * (y[:, 1] - y[:, 3]) - (x[:, 1] - x[:, 3]) * (y[:, 0] - y[:, 2])) / 2
    whole = quad & (size > 0) & (x.min(1) >= rect[0]) & (x.max(1) <= rect[2]) & (y.min(1) >= rect[1]) & (y.max(1) <= rect[3])
    out[whole] = 1.0
    cut = np.flatnonzero(quad & ~whole & (size > 0))
    if len(cut):
        out[cut] = np.minimum(_quads_inside(x[cut], y[cut], *[v[cut] for v in rect]) / size[cut], 1.0)
    rest = np.flatnonzero(~quad & (p.n > 2))
    if len(rest):
        some = p.take(rest)
        area = some.area()
        out[rest] = np.divide(some.in_rectangle(*[v[rest] for v in rect]).area(), area, out=np.zeros(len(rest)), where=area > 0)
    return pa.array(out)


def _quads_inside(x: np.ndarray, y: np.ndarray, a0: np.ndarray, b0: np.ndarray, a1: np.ndarray, b1: np.ndarray) -> np.ndarray:
    """Area of quadrilaterals inside rectangles, by the strips below their edges: see geometry._quad_in_rect."""
    total = np.zeros(len(x))
    for k in range(4):
        xk, yk, xn, yn = x[:, k], y[:, k], x[:, (k + 1) % 4], y[:, (k + 1) % 4]
        left, right = np.clip(xk, a0, a1), np.clip(xn, a0, a1)
        slope = np.divide(yn - yk, xn - xk, out=np.zeros_like(xk), where=xn != xk)
        ya, yb = yk + (left - xk) * slope, yk + (right - xk) * slope
        ca, cb = np.clip(ya, b0, b1), np.clip(yb, b0, b1)
        above = np.maximum(yb - b1, 0.0) - np.maximum(ya - b1, 0.0)
        flat = ((ca == ya) & (cb == yb)) | (np.abs(yb - ya) < 1e-6)
        mean = (ca + cb) / 2 - b0
        height = np.where(flat, mean, np.divide((cb - ca) * mean + above * (b1 - b0), yb - ya, out=np.zeros_like(xk), where=~flat))
        total += (right - left) * height
    return np.abs(total)


def _meeting(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of envelopes that meet, in parts that come of about `most` candidates: the second ones
    are sorted by their left side, and those that reach a first one from there lie next to each other."""
    right = np.flatnonzero(b[0] <= b[2])
    right = right[np.argsort(b[0][right], kind="stable")]
    left = np.flatnonzero(a[0] <= a[2])
    if not len(right) or not len(left):
        return
    start = b[0][right]
    low = np.searchsorted(start, a[0][left] - (b[2] - b[0])[right].max() * (1 + 1e-9) - 1e-9, "left")
    n = np.maximum(np.searchsorted(start, a[2][left], "right") - low, 0)
    upto, done = np.cumsum(n), 0
    while done < len(left):
        end = max(done + 1, int(np.searchsorted(upto, upto[done] - n[done] + most, "right")))
        many = n[done:end]
        i = np.repeat(left[done:end], many)
        j = right[np.repeat(low[done:end], many) + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)]
        meet = (b[2][j] >= a[0][i]) & (b[1][j] <= a[3][i]) & (b[3][j] >= a[1][i])
        yield i[meet], j[meet]
        done = end


def alike(first: Polygons, second: Polygons, threshold: float, eps: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs whose IoU (0 if the union is at most `eps`) reaches a threshold above 0. The envelopes'
    intersection bounds the polygons', so most pairs need no clipping."""
    a, b, sa, sb = first.envelopes(), second.envelopes(), first.area(), second.area()
    found = []
    for i, j in _meeting(a, b):
        most = (np.minimum(a[2][i], b[2][j]) - np.maximum(a[0][i], b[0][j])) * (np.minimum(a[3][i], b[3][j]) - np.maximum(a[1][i], b[1][j]))
        able = most * 1.000001 >= threshold * (sa[i] + sb[j] - most)
        i, j = i[able], j[able]
        inter = first.take(i).within(second.take(j)).area()
        union = sa[i] + sb[j] - inter
        ok = (union > eps) & (np.divide(inter, union, out=np.zeros_like(inter), where=union > eps) >= threshold)
        found.append((i[ok], j[ok]))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *[f[k] for f in found]]) for k in (0, 1))


def extents(p: Polygons, c: np.ndarray, s: np.ndarray) -> dict[str, np.ndarray]:
    """u0, u1, v0, v1 of polygons in frames turned by an angle of cosine c and sine s."""
    held = np.arange(p.x.shape[1]) < p.n[:, None]
    spans = {"u": p.x * c[:, None] + p.y * s[:, None], "v": p.y * c[:, None] - p.x * s[:, None]}
    ends = {f"{k}0": np.where(held, v, np.inf).min(1) for k, v in spans.items()}
    return ends | {f"{k}1": np.where(held, v, -np.inf).max(1) for k, v in spans.items()}


def compatible_pairs(p: Polygons, seq: np.ndarray, angle: np.ndarray, edge: np.ndarray, c: np.ndarray, s: np.ndarray, policy) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that recovery.cluster_links finds among the candidates of one parent, the first before
    the second in `seq`: envelopes widened by the largest gap allowed meet, then extents are compared along the
    first one's angle."""
    box, found = p.envelopes(), []
    own = extents(p, c, s)
    reach = 2 * np.maximum(policy.gap_floor, policy.gap_ratio * 1.5 * np.maximum(box[2] - box[0], box[3] - box[1]))
    wide = (box[0] - reach, box[1] - reach, box[2] + reach, box[3] + reach)
    turn = np.mod(angle, 180.0)
    for i, j in _meeting(wide, wide):
        apart = np.abs(turn[i] - turn[j])
        far = np.maximum(reach[i], reach[j])
        meet = (seq[i] < seq[j]) & (np.minimum(apart, 180.0 - apart) <= policy.cluster_angle)
        for k in (0, 1):
            meet &= (box[k][i] - far <= box[k + 2][j]) & (box[k][j] - far <= box[k + 2][i])
        i, j = i[meet], j[meet]
        a, b = {k: v[i] for k, v in own.items()}, extents(p.take(j), c[i], s[i])
        inter, near, hull = {}, {}, {}
        for k in "uv":
            low, high = (a[f"{k}0"], b[f"{k}0"]), (a[f"{k}1"], b[f"{k}1"])
            apart = np.maximum(*low) - np.minimum(*high)
            inter[k], hull[k] = np.maximum(np.minimum(*high) - np.maximum(*low), 0.0), np.maximum(*high) - np.minimum(*low)
            near[k] = np.maximum(apart, 0.0) <= np.maximum(policy.gap_floor, policy.gap_ratio * np.maximum(high[0] - low[0], high[1] - low[1]))
        whole = (hull["u"] > 0) & (hull["v"] > 0)
        ratio = np.divide(inter["u"] * inter["v"], hull["u"] * hull["v"], out=np.zeros(len(i)), where=whole)
        linked = (ratio >= policy.hull_iou) | ((edge[i] | edge[j]) & near["u"] & near["v"]) | ((inter["u"] > 0) & (inter["v"] > 0))
        found.append((i[linked], j[linked]))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *[f[k] for f in found]]) for k in (0, 1))


def _half_up(value: np.ndarray, digits: int) -> np.ndarray:
    return np.floor(value * 10.0**digits + (0.5 + 1e-7)) / 10.0**digits


def _boxes(p: Polygons) -> tuple[np.ndarray, ...]:
    """Boxes cx, cy, width, height, degrees of rectangles given by four corners in any order, as
    geometry.rotated_box rounds them, and whether there is one."""
    x, y = p.x[:, :4], p.y[:, :4]
    cx, cy = x.sum(1) / 4, y.sum(1) / 4
    turn = np.argsort(np.arctan2(y - cy[:, None], x - cx[:, None]), axis=1, kind="stable")
    x, y = np.take_along_axis(x, turn, 1), np.take_along_axis(y, turn, 1)
    ex, ey = np.roll(x, -1, 1) - x, np.roll(y, -1, 1) - y
    length = np.hypot(ex, ey)
    across = (length[:, 1:] > 0) & (np.abs(ex[:, 1:] * ex[:, :1] + ey[:, 1:] * ey[:, :1]) < 0.01 * length[:, 1:] * length[:, :1])
    second = np.where(across.any(1), across.argmax(1) + 1, 1)
    every = np.arange(len(x))
    swap = length[:, 0] < length[every, second]
    long, short = np.where(swap, second, 0), np.where(swap, 0, second)
    w, h = length[every, long], length[every, short]
    degrees = np.mod(np.degrees(np.arctan2(ey[every, long], ex[every, long])), 360.0)
    x0, y0, x1, y1 = (_half_up(v, 2) for v in (cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2))
    return x0, y0, x1, y1, _half_up(degrees, 2), (p.n == 4) & (length[:, 0] > 0)


def _inside(x: np.ndarray, y: np.ndarray, right: np.ndarray, low: np.ndarray, eps: float = 1e-6) -> np.ndarray:
    return ((x >= -eps) & (x <= right[:, None] + eps) & (y >= -eps) & (y <= low[:, None] + eps)).all(1)


def _truncate(x0, y0, x1, y1, degrees, width, height) -> tuple[Polygons, np.ndarray]:
    """geometry.truncate_box: corners of boxes shortened along one axis to fit the pixels, and whether
    a side can stay."""
    right, low = np.maximum(width - 1, 0.0), np.maximum(height - 1, 0.0)
    w, h, t = np.abs(x1 - x0), np.abs(y1 - y0), np.radians(degrees)
    c, s, cx, cy = np.cos(t), np.sin(t), (x0 + x1) / 2, (y0 + y1) / 2
    around = np.array([(-1, -1), (1, -1), (1, 1), (-1, 1)], float)
    x = cx[:, None] + around[:, 0] * (w / 2 * c)[:, None] - around[:, 1] * (h / 2 * s)[:, None]
    y = cy[:, None] + around[:, 0] * (w / 2 * s)[:, None] + around[:, 1] * (h / 2 * c)[:, None]
    over = [(np.maximum(-v, 0) + np.maximum(v - e[:, None], 0)).sum(1) for v, e in ((x, right), (y, low))]
    preferred = np.where(over[0] >= over[1], 0, 1)
    best, out_x, out_y, found = np.full(len(x), -np.inf), x.copy(), y.copy(), np.zeros(len(x), bool)

    def reach(base, step, high):
        up, down = step > 1e-12, step < -1e-12
        far = np.full(len(base), np.inf)
        far[up] = (high[up] - base[up]) / step[up]
        far[down] = -base[down] / step[down]
        return far

    for axis in (0, 1):
        size, across = (w, h) if axis == 0 else (h, w)
        ux, uy = (c, s) if axis == 0 else (-s, c)
        for sign in (-1, 1):
            kept = {(0, -1): (0, 3), (0, 1): (1, 2), (1, -1): (0, 1), (1, 1): (3, 2)}[axis, sign]
            dx, dy = -sign * ux, -sign * uy
            length = size
            for k in kept:
                length = np.minimum(length, np.minimum(reach(x[:, k], dx, right), reach(y[:, k], dy, low)))
            nx, ny = x.copy(), y.copy()
            for k in kept:
                far = k ^ 1 if axis == 0 else 3 - k
                nx[:, far], ny[:, far] = x[:, k] + length * dx, y[:, k] + length * dy
            ok = _inside(x[:, kept], y[:, kept], right, low) & (length > 0) & (across > 0) & _inside(nx, ny, right, low)
            value = np.divide(length, size, out=np.zeros_like(length), where=size > 0) + np.where(preferred == axis, 0.05, 0.0)
            better = ok & (value > best)
            best, found = np.where(better, value, best), found | ok
            out_x, out_y = np.where(better[:, None], nx, out_x), np.where(better[:, None], ny, out_y)
    whole = _inside(x, y, right, low)
    out_x, out_y = np.where(whole[:, None], x, out_x), np.where(whole[:, None], y, out_y)
    return Polygons(out_x, out_y, np.full(len(x), 4)), (width > 0) & (height > 0) & (whole | found & (w > 0) & (h > 0))


def _project(poly: pa.Array, tile_x: pa.Array, tile_y: pa.Array, width: pa.Array, height: pa.Array) -> pa.Array:
    if poly.null_count:  # callers leave out by null what needs no projection
        some = poly.is_valid()
        made = _project(*[v.filter(some) for v in (poly, tile_x, tile_y, width, height)])
        place = np.cumsum(np.asarray(some)) - 1
        return made.take(pa.array(place, mask=~np.asarray(some)))
    p = Polygons.of(poly)
    x, y, w, h = (np.asarray(v, np.float64) for v in (tile_x, tile_y, width, height))
    area = p.area()
    seen = p.in_rectangle(x, y, x + w, y + h).area()
    overlap = np.divide(seen, area, out=np.zeros_like(seen), where=area > 0)
    x0, y0, x1, y1, degrees, ok = _boxes(Polygons(p.x - x[:, None], p.y - y[:, None], p.n))
    cut, fits = _truncate(x0, y0, x1, y1, degrees, w, h)
    ok &= fits & (overlap > 0)
    size = (x1 - x0) * (y1 - y0)
    retained = np.divide(cut.area(), size, out=np.zeros_like(size), where=size != 0)
    return pa.StructArray.from_arrays([cut.lists(ok), pa.array(overlap), pa.array(retained, mask=size == 0)], ["points", "overlap", "retained"], mask=pa.array(~ok))


_D = T.DoubleType()
_RING = T.ArrayType(T.StructType([T.StructField("x", _D), T.StructField("y", _D)]))
_AREAS = T.StructType([T.StructField(k, _D) for k in ("inter", "a", "b")])
_SEEN = T.StructType([T.StructField("points", _RING), T.StructField("overlap", _D), T.StructField("retained", _D)])


def overlaps(first: Column, second: Column) -> Column:
    """Struct of inter, a, b: areas of the intersection with a convex quadrilateral, and of both."""
    return F.arrow_udf(_overlaps, _AREAS)(first, second)


def project(poly: Column, tile_x: Column, tile_y: Column, width: Column, height: Column) -> Column:
    """Struct points, overlap, retained of rectangles in the pixels of tiles; null if one can't fit."""
    return F.arrow_udf(_project, _SEEN)(poly, *[v.cast("double") for v in (tile_x, tile_y, width, height)])


def shares(poly: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Shares of convex polygons' areas inside rectangles; 0 without an area."""
    return F.arrow_udf(_shares, _D)(poly, *[v.cast("double") for v in (x0, y0, x1, y1)])
