"""Point-in-polygon lookup (``latlong2county``) as a grid-cell equi-join.

Polygons arrive as a vertex table (state, county, ring, seq, lon, lat).  The
plane is cut into bands of one cell height and each polygon is clipped to the
cells of every band it crosses:

* a cell that no edge touches is inside as a whole or dropped;
* a cell with edges keeps just these, and what the edges further right do to a
  ray cast to the right.  Whether such an edge is crossed depends on y alone, and
  along a chain of edges the shared ends cancel, so that is one parity and the
  few y values where a chain enters the cell.

So the clipped polygons grow with the vertices and the cells covered, not with
vertices times cells.  Points find the polygons of their cell by an equi-join and
the even-odd test of the whole ring is answered, bit for bit, from the cell's
part of it.  A point on an edge counts as inside (as ``sp::over`` does).  Points
that hit no polygon are kept with null state/county; a point inside several
polygons takes the first by (state, county).  Vertices without coordinates are
left out; polygons with a null in their key take part like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plume.session import ensure_checkpoint_dir

_EDGE = T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")]))


def polygon_edges(vertices: DataFrame, keys=("state", "county")) -> DataFrame:
    """One row per edge of the closed rings: keys, x1, y1, x2, y2."""
    ring = Window.partitionBy(*keys, "ring").orderBy("seq")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    put = vertices.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    return put.select(
        *keys, F.col("lon").cast("double").alias("x1"), F.col("lat").cast("double").alias("y1"),
        F.coalesce(F.lead("lon").over(ring), F.first("lon").over(whole)).cast("double").alias("x2"),
        F.coalesce(F.lead("lat").over(ring), F.first("lat").over(whole)).cast("double").alias("y2"))


def _extent(x1, y1, x2, y2, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """The x range of each edge between two heights, a little widened, so that a
    point left or right of it is so in the rounded ray test as well."""
    slack = 1e-9 * max(1.0, *(float(np.abs(v).max()) for v in (x1, y1, x2, y2)))
    dy = y2 - y1
    with np.errstate(divide="ignore", invalid="ignore"):
        ends = [np.where(dy == 0, side, np.clip((at - y1) / dy, 0.0, 1.0))
                for side, at in ((0.0, low - slack), (1.0, high + slack))]
    a, b = (x1 + t * (x2 - x1) for t in ends)
    return (np.maximum(np.minimum(a, b) - slack, np.minimum(x1, x2)),
            np.minimum(np.maximum(a, b) + slack, np.maximum(x1, x2)))


def clip_band(x1, y1, x2, y2, band: int, cell: float) -> list[tuple]:
    """One polygon's edges in one band -> (cx, inside, base, ys, edge numbers):
    whole inside cells (no edges), then the cells with edges."""
    low, high = band * cell, (band + 1) * cell
    left, right = _extent(x1, y1, x2, y2, low, high)
    first, last = np.floor(left / cell).astype(np.int64), np.floor(right / cell).astype(np.int64)
    mixed = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)]))
    out = []
    crosses_middle = (y1 > (low + high) / 2) != (y2 > (low + high) / 2)
    for c, following in zip(mixed.tolist(), [*mixed[1:].tolist(), None]):
        near, beyond = np.flatnonzero((first <= c) & (last >= c)), first > c
        ends = np.r_[y1[beyond], y2[beyond]]
        ends = ends[ends > low]  # the others lie below every point of the band
        above = ends >= high     # these above every one
        ys, many = np.unique(ends[~above], return_counts=True)
        out.append((c, False, int(above.sum() % 2), ys[many % 2 == 1].tolist(), near.tolist()))
        if following is not None and following > c + 1 and crosses_middle[beyond].sum() % 2:
            out += [(k, True, 0, [], []) for k in range(c + 1, following)]
    return out


def polygon_cells(edges: DataFrame, cell: float, keys=("state", "county")) -> DataFrame:
    """The clipped polygons: keys, cx, cy, inside, base, ys, edges."""
    def height(c: str) -> Column:
        return F.floor(F.col(c) / F.lit(cell))

    bands = edges.withColumn("cy", F.explode(F.sequence(
        F.least(height("y1"), height("y2")), F.greatest(height("y1"), height("y2")))))
    schema = T.StructType([*edges.select(*keys).schema, T.StructField("cx", T.LongType()),
                           T.StructField("cy", T.LongType()), T.StructField("inside", T.BooleanType()),
                           T.StructField("base", T.IntegerType()), T.StructField("ys", T.ArrayType(T.DoubleType())),
                           T.StructField("edges", _EDGE)])
    names = list(keys)

    def clipped(table: pa.Table) -> pa.Table:
        xy = [np.asarray(table[c]) for c in ("x1", "y1", "x2", "y2")]
        band = table["cy"][0].as_py()
        key = {k: table[k][0].as_py() for k in names}
        rows = [{**key, "cx": c, "cy": band, "inside": inside, "base": base, "ys": ys,
                 "edges": [dict(zip(("x1", "y1", "x2", "y2"), (float(v[i]) for v in xy))) for i in at]}
                for c, inside, base, ys, at in clip_band(*xy, band, cell)]
        types = {k: table.schema.field(k).type for k in names}
        point = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])
        return pa.Table.from_pylist(rows, schema=pa.schema([
            *types.items(), ("cx", pa.int64()), ("cy", pa.int64()), ("inside", pa.bool_()), ("base", pa.int32()),
            ("ys", pa.list_(pa.float64())), ("edges", pa.list_(point))]))

    return bands.groupBy(*keys, "cy").applyInArrow(clipped, schema)


# even-odd crossing count plus an on-edge test; try_divide guards the
# horizontal edges the crossing test already excludes (ANSI mode)
_INSIDE = """
  c.inside OR exists(c.edges, e ->
      (px - e.x1) * (e.y2 - e.y1) = (py - e.y1) * (e.x2 - e.x1)
      AND px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
      AND py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))
  OR (c.base + size(filter(c.ys, y -> y > py)) + aggregate(c.edges, 0, (acc, e) ->
      acc + CASE WHEN ((e.y1 > py) != (e.y2 > py))
                  AND px < try_divide((e.x2 - e.x1) * (py - e.y1), (e.y2 - e.y1)) + e.x1
                 THEN 1 ELSE 0 END)) % 2 = 1
"""


def cell_bytes(cells: DataFrame, keys=("state", "county")) -> int:
    """About how many bytes the clipped polygons take in memory."""
    names = sum((F.coalesce(F.length(F.col(k).cast("string")), F.lit(0)) + 16 for k in keys), F.lit(0))
    row = cells.agg(F.sum(F.lit(64) + names + 8 * F.size("ys") + 48 * F.size("edges")).alias("n")).first()
    return row["n"] or 0


def points_to_polygons(points: DataFrame, vertices: DataFrame, x: str, y: str,
                       point_key: list[str], cell: float, keys=("state", "county"),
                       max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Left lookup: every point row plus the containing polygon's keys (or null).

    The clipped polygons are broadcast if they take at most
    ``max_broadcast_bytes`` (measured); beyond that points and cells meet in a
    shuffled join on the cell, where AQE splits a cell that holds many points.
    """
    keys = list(keys)
    ensure_checkpoint_dir(points.sparkSession)
    # clipped once, for the size check and the join
    cells = polygon_cells(polygon_edges(vertices, keys), cell, keys).checkpoint(eager=True)
    # one row per cell with its candidate polygons, so every point row is looked up
    # by itself: rows with repeated or null keys or coordinates all stay
    per_cell = cells.groupBy("cx", "cy").agg(
        F.collect_list(F.struct(*keys, "inside", "base", "ys", "edges")).alias("_cands"))
    if cell_bytes(cells, keys) <= max_broadcast_bytes:
        per_cell = F.broadcast(per_cell)
    pts = points.withColumns({
        "px": F.col(x).cast("double"), "py": F.col(y).cast("double"),
        "cx": F.floor(F.col(x).cast("double") / F.lit(cell)), "cy": F.floor(F.col(y).cast("double") / F.lit(cell)),
    }).join(per_cell, on=["cx", "cy"], how="left")
    names = ", ".join(f"'{k}', c.`{k}`" for k in keys)
    pts = pts.withColumn("_hit", F.expr(
        f"array_min(transform(filter(_cands, c -> coalesce({_INSIDE}, false)), c -> named_struct({names})))"))
    other = [c for c in points.columns if c not in point_key]
    return pts.select(*point_key, *other, *[F.col("_hit")[k].alias(k) for k in keys])
