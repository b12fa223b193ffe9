"""Kernels for polygons of any form, in numpy; used inside Arrow functions where boxes are not enough.

A polygon is a sequence of (x, y). Its inside follows the even-odd rule, so self-crossing rings need no repair.
Areas come from vertical slabs between all vertices and crossings: within a slab edges do not cross, so the middle
line of a slab decides.
"""

from __future__ import annotations

import numpy as np


def as_ring(polygon) -> np.ndarray | None:
    """[n, 2] without a repeated last vertex, or None with fewer than three vertices or values that are not finite."""
    if polygon is None or len(polygon) < 3:
        return None
    r = np.asarray([(p["x"], p["y"]) if isinstance(p, dict) else (p[0], p[1]) for p in polygon], dtype=float)
    if len(r) > 3 and (r[0] == r[-1]).all():
        r = r[:-1]
    return r if len(r) >= 3 and np.isfinite(r).all() else None


def _edges(ring: np.ndarray) -> np.ndarray:
    return np.concatenate([ring, np.roll(ring, -1, axis=0)], axis=1)


def _crossing_xs(e: np.ndarray) -> np.ndarray:
    """x of all crossings between edges of [n, 4]."""
    p, d = e[:, :2], e[:, 2:] - e[:, :2]
    den = d[:, None, 0] * d[None, :, 1] - d[:, None, 1] * d[None, :, 0]
    off = p[None, :, :] - p[:, None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (off[..., 0] * d[None, :, 1] - off[..., 1] * d[None, :, 0]) / den
        u = (off[..., 0] * d[:, None, 1] - off[..., 1] * d[:, None, 0]) / den
    hit = (den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    i, j = np.nonzero(hit)
    return p[i, 0] + t[i, j] * d[i, 0]


def _spans(e: np.ndarray, x: float) -> np.ndarray:
    """Sorted y where the line at x crosses the edges; consecutive pairs bound the inside.

    An edge has its left end but not its right one, so a line through a vertex crosses an even number of edges, too: the
    middle of a slab of neighbouring floats is one of its sides.
    """
    a, b = e[:, 0], e[:, 2]
    cut = (a <= x) != (b <= x)
    t = (x - a[cut]) / (b[cut] - a[cut])
    return np.sort(e[cut, 1] + t * (e[cut, 3] - e[cut, 1]))


def _length(y: np.ndarray) -> float:
    return float((y[1::2] - y[0::2]).sum())


def _as_box(ring: np.ndarray) -> tuple[float, float, float, float] | None:
    """x0, y0, x1, y1 of a ring that is an upright box."""
    if len(ring) != 4:
        return None
    (ax, ay), (bx, by), (cx, cy), (dx, dy) = ring.tolist()
    if (ax == bx and by == cy and cx == dx and dy == ay) or (ay == by and bx == cx and cy == dy and dx == ax):
        return min(ax, cx), min(ay, cy), max(ax, cx), max(ay, cy)
    return None


def areas(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """Areas of a, of b and of their intersection; of two upright boxes without slabs."""
    p, q = _as_box(a), _as_box(b)
    if p and q:
        common = max(min(p[2], q[2]) - max(p[0], q[0]), 0.0) * max(min(p[3], q[3]) - max(p[1], q[1]), 0.0)
        return (p[2] - p[0]) * (p[3] - p[1]), (q[2] - q[0]) * (q[3] - q[1]), common
    return _slab_areas(a, b)


def _slab_areas(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """``areas`` of any two rings."""
    ea, eb = _edges(a), _edges(b)
    both = np.concatenate([ea, eb])
    xs = np.unique(np.concatenate([both[:, 0], _crossing_xs(both)]))
    total = np.zeros(3)
    for x0, x1 in zip(xs[:-1], xs[1:], strict=True):
        ya, yb = _spans(ea, (x0 + x1) / 2), _spans(eb, (x0 + x1) / 2)
        common = 0.0
        for s, t in zip(ya[0::2], ya[1::2], strict=True):
            common += float(np.maximum(np.minimum(t, yb[1::2]) - np.maximum(s, yb[0::2]), 0).sum())
        total += np.array([_length(ya), _length(yb), common]) * (x1 - x0)
    return float(total[0]), float(total[1]), float(total[2])


def area(ring: np.ndarray) -> float:
    """Area by the even-odd rule."""
    return areas(ring, ring)[0]


def iou(a, b) -> float:
    """Intersection over union; 0 if a polygon is invalid, empty or apart from the other."""
    ra, rb = as_ring(a), as_ring(b)
    if ra is None or rb is None or (ra.max(axis=0) < rb.min(axis=0)).any() or (rb.max(axis=0) < ra.min(axis=0)).any():
        return 0.0
    x, y, common = areas(ra, rb)
    union = x + y - common
    return common / union if union > 0 else 0.0


def contains(ring: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Which points lie inside the ring."""
    e = _edges(ring)
    x, y = points[:, 0][:, None], points[:, 1][:, None]
    a, b = e[None, :, 1], e[None, :, 3]
    spans = (a > y) != (b > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = e[None, :, 0] + (y - a) / (b - a) * (e[None, :, 2] - e[None, :, 0])
    return ((spans & (x < at)).sum(axis=1) % 2) == 1


def distance(a, b) -> float:
    """Least distance of two polygons, 0 if they meet; infinite if one is invalid."""
    ra, rb = as_ring(a), as_ring(b)
    if ra is None or rb is None:
        return float("inf")
    if contains(ra, rb[:1])[0] or contains(rb, ra[:1])[0] or len(_crossing_between(_edges(ra), _edges(rb))):
        return 0.0

    def to_edges(points: np.ndarray, e: np.ndarray) -> float:
        p, d = e[None, :, :2], (e[:, 2:] - e[:, :2])[None]
        n = np.maximum((d * d).sum(axis=2), 1e-300)
        t = np.clip((((points[:, None] - p) * d).sum(axis=2)) / n, 0, 1)
        return float(np.sqrt((((p + t[..., None] * d) - points[:, None]) ** 2).sum(axis=2)).min())

    return min(to_edges(ra, _edges(rb)), to_edges(rb, _edges(ra)))


def _crossing_between(ea: np.ndarray, eb: np.ndarray) -> np.ndarray:
    """Parameters [i, j, t] of crossings of edges of a with edges of b."""
    p, d = ea[:, :2], ea[:, 2:] - ea[:, :2]
    q, f = eb[:, :2], eb[:, 2:] - eb[:, :2]
    den = d[:, None, 0] * f[None, :, 1] - d[:, None, 1] * f[None, :, 0]
    off = q[None] - p[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (off[..., 0] * f[None, :, 1] - off[..., 1] * f[None, :, 0]) / den
        u = (off[..., 0] * d[:, None, 1] - off[..., 1] * d[:, None, 0]) / den
    i, j = np.nonzero((den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1))
    return np.stack([i, j, t[i, j]], axis=1) if len(i) else np.zeros((0, 3))


def union_rings(polygons: list) -> list[np.ndarray]:
    """Outer rings of the union of polygons. Holes are lost.

    All edges are cut where they cross; a piece belongs to the outline if just one of its sides is covered. Pieces are
    walked with the inside on one hand; rings of positive orientation are outer ones.
    """
    rings = [r for r in map(as_ring, polygons) if r is not None]
    if not rings:
        return []
    edges = np.concatenate([_edges(r) for r in rings])
    cuts: list[list[float]] = [[0.0, 1.0] for _ in edges]
    for i, _, t in _crossing_between(edges, edges):
        cuts[int(i)].append(float(t))
    for i, e in enumerate(edges):  # vertices that lie on an edge cut it, too
        d = e[2:] - e[:2]
        n = float(d @ d)
        if n == 0:
            continue
        off = edges[:, :2] - e[:2]
        t = off @ d / n
        on = (np.abs(off[:, 0] * d[1] - off[:, 1] * d[0]) <= 1e-9 * max(n, 1)) & (t > 0) & (t < 1)
        cuts[i] += t[on].tolist()
    pieces: dict[tuple, tuple] = {}
    for e, ts in zip(edges, cuts, strict=True):
        p, d = e[:2], e[2:] - e[:2]
        ts = np.unique(np.round(ts, 12))
        pts = p + ts[:, None] * d
        for s, t in zip(pts[:-1], pts[1:], strict=True):
            a, b = tuple(np.round(s, 6)), tuple(np.round(t, 6))
            if a != b:
                pieces[min((a, b), (b, a))] = (a, b)
    out: dict[tuple, list[tuple]] = {}
    segments = list(pieces.values())
    mid = np.array([((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in segments])
    way = np.array([(b[0] - a[0], b[1] - a[1]) for a, b in segments])
    size = np.sqrt((way**2).sum(axis=1, keepdims=True))
    normal = np.stack([-way[:, 1], way[:, 0]], axis=1) / size * np.minimum(1e-4, size / 10)
    left = np.any([contains(r, mid + normal) for r in rings], axis=0)
    right = np.any([contains(r, mid - normal) for r in rings], axis=0)
    for (a, b), lf, rt in zip(segments, left, right, strict=True):
        if lf != rt:
            s, t = (a, b) if lf else (b, a)
            out.setdefault(s, []).append(t)
    result = []
    while out:
        start = next(iter(out))
        ring, here, came = [start], start, None
        while True:
            options = out[here]
            if came is None or len(options) == 1:
                nxt = options.pop()
            else:  # at a touching point turn as far to the outside as possible
                base = np.arctan2(came[1] - here[1], came[0] - here[0])
                nxt = max(options, key=lambda o: (np.arctan2(o[1] - here[1], o[0] - here[0]) - base) % (2 * np.pi))
                options.remove(nxt)
            if not options:
                del out[here]
            came, here = here, nxt
            if here == start or here not in out:
                break
            ring.append(here)
        r = np.array(ring)
        x, y = r[:, 0], r[:, 1]
        if len(r) >= 3 and float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) > 0:
            result.append(r)
    return result


def mean_thickness(ring: np.ndarray, steps: int = 32) -> float:
    """The lesser of the mean chord lengths along columns and along rows of a grid."""
    best = float("inf")
    for flip in (False, True):
        r = ring[:, ::-1] if flip else ring
        e = _edges(r)
        x0, x1 = r[:, 0].min(), r[:, 0].max()
        chords = [_length(_spans(e, x)) for x in x0 + (np.arange(steps) + 0.5) * (x1 - x0) / steps]
        chords = [c for c in chords if c > 0]
        best = min(best, float(np.mean(chords)) if chords else 0.0)
    return best


# The eight neighbours of a pixel, clockwise
_AROUND = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))


def mask_outlines(mask: np.ndarray) -> list[np.ndarray]:
    """Outer outlines [n, 2] (x, y) of the 8-connected parts of a mask, without points inside straight runs; n >= 3."""
    m = np.pad(np.asarray(mask, dtype=bool), 1)
    seen = np.zeros_like(m)
    out = []
    for y, x in zip(*np.nonzero(m), strict=True):
        if seen[y, x]:
            continue
        stack = [(y, x)]
        seen[y, x] = True
        while stack:
            cy, cx = stack.pop()
            for dy, dx in _AROUND:
                if m[cy + dy, cx + dx] and not seen[cy + dy, cx + dx]:
                    seen[cy + dy, cx + dx] = True
                    stack.append((cy + dy, cx + dx))
        # walk around the part from its topmost, leftmost pixel
        path, here, look, first = [(x, y)], (y, x), 7, None
        while True:
            for k in range(8):
                d = (look + k) % 8
                ny, nx = here[0] + _AROUND[d][0], here[1] + _AROUND[d][1]
                if m[ny, nx]:
                    break
            else:
                break
            if here == (y, x) and d == first:
                break
            first = d if first is None else first
            here, look = (ny, nx), (d + 6) % 8 if d % 2 == 0 else (d + 5) % 8
            path.append((nx, ny))
        p = np.array(path[:-1] if len(path) > 1 and path[-1] == path[0] else path) - 1
        if len(p) >= 3:
            way = np.roll(p, -1, axis=0) - p
            turn = (way != np.roll(way, 1, axis=0)).any(axis=1)
            p = p[turn]
        if len(p) >= 3:
            out.append(p)
    return out
