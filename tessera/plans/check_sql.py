"""Pieces of checking SQL: geometry as list expressions, written apart from the Spark builders."""

from __future__ import annotations


def ring(cx: str, cy: str, w: str, h: str, degrees: str) -> str:
    """Corners of a rotated box as a list of structs."""
    c, s = f"cos(radians({degrees}))", f"sin(radians({degrees}))"
    corner = lambda i, j: f"{{'x': {cx} + ({i}) * ({w}) / 2 * {c} - ({j}) * ({h}) / 2 * {s}, 'y': {cy} + ({i}) * ({w}) / 2 * {s} + ({j}) * ({h}) / 2 * {c}}}"
    return f"[{corner(-1, -1)}, {corner(1, -1)}, {corner(1, 1)}, {corner(-1, 1)}]"


def shoelace(p: str) -> str:
    return f"coalesce(list_sum(list_transform(range(1, len({p}) + 1), lambda i: {p}[i].x * {p}[i % len({p}) + 1].y - {p}[i % len({p}) + 1].x * {p}[i].y)), 0) / 2"


def poly_area(p: str) -> str:
    return f"(CASE WHEN len({p}) >= 3 THEN abs({shoelace(p)}) ELSE 0.0 END)"


def low(p: str, axis: str) -> str:
    return f"list_min(list_transform({p}, lambda q: q.{axis}))"


def high(p: str, axis: str) -> str:
    return f"list_max(list_transform({p}, lambda q: q.{axis}))"


def centre(p: str, axis: str) -> str:
    """Vertex mean; the area centroid too for the parallelograms compared here."""
    return f"(list_sum(list_transform({p}, lambda q: q.{axis})) / len({p}))"


def half_plane(p: str, a: str, b: str, c: str) -> str:
    side = lambda v: f"(({a}) * {v}.x + ({b}) * {v}.y + ({c}))"
    here, there = f"{p}[i]", f"{p}[i % len({p}) + 1]"
    share = f"({side(here)} / ({side(here)} - {side(there)}))"
    cut = f"{{'x': {here}.x + ({there}.x - {here}.x) * {share}, 'y': {here}.y + ({there}.y - {here}.y) * {share}}}"
    return (
        f"flatten(list_transform(range(1, len({p}) + 1), lambda i: CASE WHEN {side(here)} >= 0 AND {side(there)} >= 0 THEN [{here}] "
        f"WHEN {side(here)} >= 0 THEN [{here}, {cut}] WHEN {side(there)} >= 0 THEN [{cut}] ELSE [] END))"
    )


def clipped(source: str, p: str, planes: list[tuple[str, str, str]], out: str = "clip") -> str:
    """A subquery over `source` with the clipped polygon as one more column."""
    text = f"SELECT *, {p} AS {out} FROM {source}"
    for a, b, c in planes:
        text = f"SELECT * EXCLUDE ({out}), {half_plane(out, a, b, c)} AS {out} FROM ({text})"
    return text


def rect_planes(x0: str, y0: str, x1: str, y1: str) -> list[tuple[str, str, str]]:
    return [("1", "0", f"-({x0})"), ("-1", "0", x1), ("0", "1", f"-({y0})"), ("0", "-1", y1)]


def quad_planes(q: str) -> list[tuple[str, str, str]]:
    """Half planes of a quadrilateral whose corners turn from the x axis to the y axis."""
    out = []
    for k in range(1, 5):
        a, b = f"({q}[{k}].y - {q}[{k % 4 + 1}].y)", f"({q}[{k % 4 + 1}].x - {q}[{k}].x)"
        out.append((a, b, f"-({a} * {q}[{k}].x + {b} * {q}[{k}].y)"))
    return out


def half_up(value: str, digits: int) -> str:
    return f"(floor(({value}) * 1e{digits} + 0.5000001) / 1e{digits})"


def box_iou(a: str, b: str) -> str:
    """IoU of envelopes held as structs with x0, y0, x1, y1."""
    inter = f"(greatest(least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0), 0) * greatest(least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0), 0))"
    size = lambda r: f"(({r}.x1 - {r}.x0) * ({r}.y1 - {r}.y0))"
    return f"coalesce({inter} / nullif({size(a)} + {size(b)} - {inter}, 0), 0)"


def truncated(source: str, out: str = "fit", size: int = 1024) -> str:
    """A subquery over `source` (cx, cy, w, h, rot of a box, w >= h, and tile_x, tile_y) with the corners
    that a tile would hold of the box, in tile pixels, as one more column; null if none fits."""
    most = size - 1
    text = f"SELECT *, {half_up('cx - tile_x - w / 2', 2)} AS t_x0, {half_up('cx - tile_x + w / 2', 2)} AS t_x1, {half_up('cy - tile_y - h / 2', 2)} AS t_y0, {half_up('cy - tile_y + h / 2', 2)} AS t_y1 FROM {source}"
    text = f"SELECT *, {ring('((t_x0 + t_x1) / 2)', '((t_y0 + t_y1) / 2)', '(t_x1 - t_x0)', '(t_y1 - t_y0)', 'rot')} AS t_p, cos(radians(rot)) AS t_c, sin(radians(rot)) AS t_s, t_x1 - t_x0 AS t_w, t_y1 - t_y0 AS t_h FROM ({text})"
    reach = lambda base, step: f"(CASE WHEN {step} > 1e-12 THEN ({most} - {base}) / ({step}) WHEN {step} < -1e-12 THEN -({base}) / ({step}) ELSE 1e300 END)"
    sides = {(0, -1): ((0, 3), (1, 2), "t_c", "t_s", "t_w"), (0, 1): ((1, 2), (0, 3), "(-t_c)", "(-t_s)", "t_w"), (1, -1): ((0, 1), (3, 2), "(-t_s)", "t_c", "t_h"), (1, 1): ((3, 2), (0, 1), "t_s", "(-t_c)", "t_h")}
    at = lambda k, axis: f"t_p[{k + 1}].{axis}"
    ends = [", ".join(f"{reach(at(k, a), d)}" for k in kept for a, d in (("x", dx), ("y", dy))) for kept, _, dx, dy, _ in sides.values()]
    text = "SELECT *, " + ", ".join(f"least({s[4]}, {e}) AS t_n{i}" for i, (s, e) in enumerate(zip(sides.values(), ends, strict=True))) + f" FROM ({text})"
    rings = []
    for i, (kept, far, dx, dy, _) in enumerate(sides.values()):
        corner = {k: f"{{'x': {at(k, 'x')}, 'y': {at(k, 'y')}}}" for k in kept} | {f: f"{{'x': {at(k, 'x')} + t_n{i} * {dx}, 'y': {at(k, 'y')} + t_n{i} * {dy}}}" for k, f in zip(kept, far, strict=True)}
        rings.append(f"[{', '.join(corner[k] for k in range(4))}] AS t_r{i}")
    text = f"SELECT *, {', '.join(rings)} FROM ({text})"
    inside = lambda p: f"({low(p, 'x')} >= -1e-6 AND {high(p, 'x')} <= {most + 1e-6} AND {low(p, 'y')} >= -1e-6 AND {high(p, 'y')} <= {most + 1e-6})"
    over = lambda a: f"list_sum(list_transform(t_p, lambda v: greatest(-v.{a}, 0) + greatest(v.{a} - {most}, 0)))"
    values = [f"CASE WHEN t_n{i} > 0 AND {inside(f't_r{i}')} THEN t_n{i} / {s[4]} + CASE WHEN ({over('x')} >= {over('y')}) = ({'true' if axis == 0 else 'false'}) THEN 0.05 ELSE 0 END ELSE -1 END AS t_v{i}" for i, ((axis, _), s) in enumerate(sides.items())]
    text = f"SELECT *, {inside('t_p')} AS t_whole, {', '.join(values)} FROM ({text})"
    best = "greatest(t_v0, t_v1, t_v2, t_v3)"
    chosen = "CASE WHEN t_whole THEN t_p " + " ".join(f"WHEN {best} > 0 AND t_v{i} = {best} THEN t_r{i}" for i in range(4)) + " END"
    return f"SELECT * EXCLUDE ({', '.join(f't_{k}{i}' for k in 'nrv' for i in range(4))}, t_whole, t_p, t_c, t_s, t_x0, t_x1, t_y0, t_y1), {chosen} AS {out} FROM ({text})"
