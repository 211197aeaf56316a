"""Clipped polygons against ray casting over whole rings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plume.operators import spatial

CELL = 0.25


def _whole(px, py, edges):
    on = odd = False
    for x1, y1, x2, y2 in edges:
        if (px - x1) * (y2 - y1) == (py - y1) * (x2 - x1) and min(x1, x2) <= px <= max(x1, x2) \
                and min(y1, y2) <= py <= max(y1, y2):
            on = True
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            odd = not odd
    return on or odd


def _clipped(px, py, edges):
    band = int(np.floor(py / CELL))
    mine = [e for e in edges if min(np.floor(e[1] / CELL), np.floor(e[3] / CELL)) <= band
            <= max(np.floor(e[1] / CELL), np.floor(e[3] / CELL))]
    if not mine:
        return False
    for cx, inside, base, ys, at in spatial.clip_band(*np.array(mine, float).T, band, CELL):
        if cx == int(np.floor(px / CELL)):
            near = [mine[i] for i in at]
            on = inside or _whole(px, py, near) and any(
                (px - a) * (d - b) == (py - b) * (c - a) and min(a, c) <= px <= max(a, c)
                and min(b, d) <= py <= max(b, d) for a, b, c, d in near)
            odd = base + sum(v > py for v in ys) + sum(
                (b > py) != (d > py) and px < (c - a) * (py - b) / (d - b) + a for a, b, c, d in near)
            return bool(on or odd % 2)
    return False


def _ring(points):
    return [(*p, *q) for p, q in zip(points, points[1:] + points[:1])]


def _polygons():
    rng = np.random.default_rng(0)
    out = []
    for n in (3, 7, 40, 400):
        angle = np.sort(rng.uniform(0, 2 * np.pi, n))
        r = rng.uniform(0.3, 2.0, n)
        out.append(_ring([(float(a), float(b)) for a, b in zip(1 + r * np.cos(angle), 0.5 + r * np.sin(angle))]))
    square = [(-1.0, -1.0), (2.0, -1.0), (2.0, 2.0), (-1.0, 2.0)]           # on cell borders
    hole = [(0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.5)]
    out.append(_ring(square) + _ring(hole))
    out.append(_ring([(0.0, 0.0), (1.5, 0.0), (1.5, 0.001), (0.0, 1.0)]))   # a nearly level edge
    out.append(_ring([(float(x), float(y)) for x, y in rng.integers(-4, 9, (9, 2)) / 4]))  # crosses itself
    return out


@pytest.mark.parametrize("edges", _polygons())
def test_cells_answer_like_whole_rings(edges):
    rng = np.random.default_rng(1)
    pts = np.r_[rng.uniform(-1.5, 3.5, (400, 2)), rng.integers(-6, 14, (300, 2)) / 4,
                rng.integers(-60, 140, (300, 2)) / 40, np.array([e[:2] for e in edges])]
    for px, py in pts.tolist():
        assert _clipped(px, py, edges) == _whole(px, py, edges), (px, py)


def _table(spark, polygons):
    rows = []
    for k, (key, rings) in enumerate(polygons):
        for r, ring in enumerate(rings):
            rows += [(*key, r, i, x, y) for i, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, "state string, county string, ring int, seq int, lon double, lat double")


def test_lookup_broadcast_or_shuffled(spark):
    star = [(float(a), float(b)) for a, b in zip(1.3 * np.cos(np.arange(60)), 1.1 * np.sin(np.arange(60) * 1.01))]
    polygons = [(("s", "a"), [star]), (("s", None), [[(2.0, 0.0), (3.0, 0.0), (3.0, 1.0), (2.0, 1.0)]]),
                (("s", "b"), [[(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)],
                              [(-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5)]])]
    rng = np.random.default_rng(2)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-2, 4, (500, 2)))]
    pts += [(500, 0.5, 0.5), (500, 0.5, 0.5), (None, 2.5, 0.5), (501, None, 1.0), (502, 1.0, 1.0)]
    df = spark.createDataFrame(pts, "id int, lon double, lat double")
    verts = _table(spark, polygons)

    def place(px, py):
        hits = [key for key, rings in polygons if px is not None
                and _whole(px, py, [e for r in rings for e in _ring(r)])]
        return min(hits, key=lambda k: (k[0], k[1] is not None, k[1] or ""), default=(None, None))

    want = sorted([(*p, *place(*p[1:])) for p in pts], key=str)
    for most in (64 << 20, 0):
        got = spatial.points_to_polygons(df, verts, "lon", "lat", ["id"], CELL, max_broadcast_bytes=most)
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_bytes_grow_with_vertices_not_with_cells_times_vertices(spark):
    def size(n, cell):
        angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
        ring = [(float(a), float(b)) for a, b in zip(np.cos(angle), np.sin(angle))]
        edges = spatial.polygon_edges(_table(spark, [(("s", "c"), [ring])]))
        cells = spatial.polygon_cells(edges, cell)
        return spatial.cell_bytes(cells), cells.select(F.sum(F.size("edges"))).first()[0]

    few, many = size(400, 0.1), size(4000, 0.1)
    assert many[1] <= 4000 * 1.5 and many[0] <= 15 * few[0]
    fine = size(4000, 0.05)
    assert fine[1] <= 4000 * 1.6 and fine[0] <= 2 * many[0]
