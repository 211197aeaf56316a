"""Embedding near-duplicates by an epsilon grid order join.

On unit vectors a cosine of at least c is a distance of at most
eps = sqrt(2 - 2 c).  Vectors are sorted by the grid cells (a quarter of eps wide)
of their coordinates on the 16 leading principal dimensions; any orthonormal projection
shortens distances, so it is enough to fit those on a bounded sample.  The
sequence is cut into blocks, blocks are joined into intervals of four, and
pairs of intervals are refined level by level from the whole sequence down,
dropping every pair whose bounding boxes lie more than eps apart.  The leaves of
that refinement are tiles: runs of blocks of one vector length and at most
``tile_bytes``, so that small blocks do not each travel to every other one.  A
surviving pair of tiles is joined in one task, again level by level over
intervals of 256 rows and more that boxes may prove distant.  Rows of the
intervals left are compared on the leading dimensions first, and only pairs
within eps there meet in exact double-precision products of whole vectors.

Identical vectors are one row, so exact copies meet once.  A tile pair returns
link counts and one component label per row, never the pairs themselves.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components keep their row, link with nothing and form their own component;
vectors of different lengths never link; a null vec_id is counted as a partner
but names no component (its row has kept = false); repeated rows are vectors of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plume.llm.common import cut
from plume.llm.components import connected_components

LEAD = 16
FAN = 4
#: cells of the order are a quarter of eps wide: two rows of one interval differ by
#: little on the first axes, so boxes lie apart once enough rows fill the cells
CELLS = 4


def is_usable(vec: Column) -> Column:
    """Not null or empty, all components finite, some component not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix_of(column: pa.Array) -> np.ndarray:
    """Rows of equal length from a list column."""
    flat = np.asarray(column.flatten()).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in squares
    x = x / big
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(reps: DataFrame, max_fit: int) -> dict[int, np.ndarray]:
    """Leading principal axes by vector length, fitted on at most ``max_fit``
    vectors chosen by hash.  Lengths not in the sample get plain coordinates."""
    got = reps.select("vec").orderBy(F.xxhash64("vec")).limit(max_fit).toArrow()["vec"]
    sizes = np.asarray(pc.list_value_length(got))
    axes = {}
    for d in np.unique(sizes).tolist():
        x = unit(matrix_of(pa.array(got.filter(pa.array(sizes == d)).to_pylist(), got.type)))
        x = x - x.mean(axis=0)
        axes[d] = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :LEAD]
    return axes


def _project(x: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    d = x.shape[1]
    y = x @ axes.get(d, np.eye(d)[:, :LEAD])
    return np.pad(y, ((0, 0), (0, LEAD - y.shape[1])))


def _grid(batches: Iterator[pa.RecordBatch], axes: dict, eps: float) -> Iterator[pa.RecordBatch]:
    """Adds the grid cells: vector length, then cells on the leading axes."""
    for b in batches:
        vec = b.column(b.schema.get_field_index("vec"))
        sizes = np.asarray(pc.list_value_length(vec))
        cells = np.empty((b.num_rows, LEAD + 1), np.int32)
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            y = _project(unit(matrix_of(vec.take(pa.array(at)))), axes)
            cells[at] = np.column_stack([np.full(len(at), d), np.floor(y * (CELLS / eps))])
        offsets = pa.array(np.arange(b.num_rows + 1) * (LEAD + 1), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.ListArray.from_arrays(offsets, pa.array(cells.ravel()))],
            [*b.schema.names, "cells"])


def _pack(batches: Iterator[pa.RecordBatch], axes: dict, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one vector length as block rows with bounding boxes."""
    held: list[tuple] = []

    def block() -> pa.RecordBatch:
        x = np.stack([h[2] for h in held])
        y = _project(unit(x), axes)
        return pa.RecordBatch.from_pylist([{
            "dim": x.shape[1], "nodes": np.array([h[0] for h in held], np.int64).tobytes(),
            "weights": np.array([h[1] for h in held], np.int64).tobytes(), "vecs": x.tobytes(),
            "low": y.min(axis=0).tolist(), "high": y.max(axis=0).tolist()}], schema=_BLOCK)

    for b in batches:
        nodes, weights = (np.asarray(b.column(b.schema.get_field_index(c))) for c in ("node", "weight"))
        vec = b.column(b.schema.get_field_index("vec"))
        for i in range(b.num_rows):
            x = np.asarray(vec[i].values).astype(np.float64)
            if held and (len(x) != len(held[0][2]) or len(held) * x.nbytes >= block_bytes):
                yield block()
                held = []
            held.append((nodes[i], weights[i], x))
    if held:
        yield block()


_BLOCK = pa.schema([("dim", pa.int32()), ("nodes", pa.binary()), ("weights", pa.binary()),
                    ("vecs", pa.binary()), ("low", pa.list_(pa.float64())),
                    ("high", pa.list_(pa.float64()))])


def interval_pairs(boxes: DataFrame, n_blocks: int, eps: float) -> DataFrame:
    """(a, b), a <= b: pairs of blocks that boxes cannot prove distant.

    ``boxes``: seq (0..n_blocks-1), dim, low, high (of ``LEAD`` axes or fewer).  Intervals are refined from
    the root; only children of surviving pairs are ever looked at.
    """
    sides = [f"lo{k}" for k in range(LEAD)] + [f"hi{k}" for k in range(LEAD)]
    level = boxes.select(F.col("seq").alias("at"), F.col("dim").alias("dlo"), F.col("dim").alias("dhi"),
                         *[F.get("low", F.lit(k)).alias(f"lo{k}") for k in range(LEAD)],
                         *[F.get("high", F.lit(k)).alias(f"hi{k}") for k in range(LEAD)])
    levels, n = [level], n_blocks
    while n > 1:
        n = -(-n // FAN)
        up = [(F.min if c.startswith(("lo", "dlo")) else F.max)(c).alias(c) for c in ["dlo", "dhi", *sides]]
        levels.append(levels[-1].groupBy(F.floor(F.col("at") / FAN).alias("at")).agg(*up))
    pairs = boxes.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    kids = F.sequence(F.lit(0), F.lit(FAN - 1))
    for depth, lv in reversed(list(enumerate(levels))):
        if depth < len(levels) - 1:
            pairs = pairs.withColumn("i", F.explode(kids)).withColumn("j", F.explode(kids)) \
                .select((F.col("a") * FAN + F.col("i")).alias("a"), (F.col("b") * FAN + F.col("j")).alias("b")) \
                .filter("a <= b")
        one = lv.select(*[F.col(c).alias(f"x_{c}") for c in lv.columns])
        two = lv.select(*[F.col(c).alias(f"y_{c}") for c in lv.columns])
        pairs = pairs.join(one, F.col("a") == F.col("x_at")).join(two, F.col("b") == F.col("y_at"))
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"x_lo{k}") - F.col(f"y_hi{k}"),
                                    F.col(f"y_lo{k}") - F.col(f"x_hi{k}")), F.lit(2.0))
                   for k in range(LEAD)), F.lit(0.0))
        pairs = pairs.filter((F.col("x_dlo") <= F.col("y_dhi")) & (F.col("y_dlo") <= F.col("x_dhi"))
                             & (gap <= eps * eps + 1e-9)).select("a", "b")
    return pairs


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of links into fully compressed ``parent`` labels (least member)."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _pyramid(y: np.ndarray, leaf: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bounding boxes (low, high) of the intervals of ``leaf`` rows, then of
    every two of the intervals below, up to one."""
    at = np.arange(0, len(y), leaf)
    boxes = [(np.minimum.reduceat(y, at), np.maximum.reduceat(y, at))]
    while len(boxes[-1][0]) > 1:
        low, high = boxes[-1]
        at = np.arange(0, len(low), 2)
        boxes.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
    return boxes


def _close_leaves(a: list, b: list, same: bool, eps2: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that no box on any level proves distant: the intervals of
    two sequences joined recursively, all pairs of a level at once."""
    top = max(len(a), len(b)) - 1
    i = j = np.zeros(1, np.int64)
    for level in range(top, -1, -1):
        (al, ah), (bl, bh) = a[min(level, len(a) - 1)], b[min(level, len(b) - 1)]
        if level < top:
            na, nb = level < len(a) - 1, level < len(b) - 1  # a short sequence keeps its root
            i, j = ((i * 2 if na else i)[:, None, None] + np.arange(2 if na else 1)[None, :, None],
                    (j * 2 if nb else j)[:, None, None] + np.arange(2 if nb else 1)[None, None, :])
            i, j = (v.ravel() for v in np.broadcast_arrays(i, j))
            ok = (i < len(al)) & (j < len(bl))
            ok &= (i <= j) if same else True
            i, j = i[ok], j[ok]
        gap = np.maximum(np.maximum(al[i] - bh[j], bl[j] - ah[i]), 0.0)
        near = (gap * gap).sum(1) <= eps2
        i, j = i[near], j[near]
    return i, j


def join_blocks(xa: np.ndarray, wa: np.ndarray, xb: np.ndarray | None, wb: np.ndarray | None,
                cosine: float, axes: dict, leaf: int = 256,
                stats: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links of two blocks (or inside one: ``xb`` None): per row the summed
    weight of its partners and the least row of its component.

    Leaves that boxes cannot prove distant are compared on the leading axes;
    only the row pairs within eps there meet in whole vectors.  ``stats`` counts
    row pairs: all, in compared leaves, compared whole.
    """
    eps2 = 2 - 2 * cosine + 1e-9
    x = unit(xa) if xb is None else np.vstack([unit(xa), unit(xb)])
    w = wa if wb is None else np.r_[wa, wb]
    y = _project(x, axes)
    n, na = len(x), len(xa)
    # one product gives squared distances on the leading axes; single precision,
    # whose rounding the margin covers many times over
    half, one = (y * y).sum(1)[:, None], np.ones((n, 1))
    left, right = (np.hstack(v).astype(np.float32) for v in ((y, half, one), (-2 * y, one, half)))
    margin = np.float32(eps2 + 1e-4)
    links, parent = np.zeros(n, np.int64), np.arange(n)
    boxes = _pyramid(y[:na], leaf)
    others, shift = (boxes, 0) if xb is None else (_pyramid(y[na:], leaf), na)
    count = {"all": na * (na - 1) // 2 if xb is None else na * (n - na), "leaves": 0, "whole": 0}
    for p, q in zip(*(v.tolist() for v in _close_leaves(boxes, others, xb is None, eps2))):
        a, b = p * leaf, min(na, (p + 1) * leaf)
        c = q * leaf + shift
        d = min(na if xb is None else n, c + leaf)
        inside = a == c and xb is None
        close = left[a:b] @ right[c:d].T <= margin
        if inside:
            close = np.triu(close, 1)
        i, j = np.divmod(np.flatnonzero(close), d - c)
        if 8 * len(i) > close.size:  # a dense pair is one product
            near = (x[a:b] @ x[c:d].T >= cosine) & close
            i, j = np.nonzero(near)
            count["whole"] += close.size
        else:
            count["whole"] += len(i)
            near = (x[a + i] * x[c + j]).sum(1) >= cosine
            i, j = i[near], j[near]
        count["leaves"] += (b - a) * (b - a - 1) // 2 if inside else close.size
        if len(i):
            i, j = i + a, j + c
            links += np.bincount(i, w[j], n).astype(np.int64) + np.bincount(j, w[i], n).astype(np.int64)
            parent = _merge(parent, i, j)
    if stats is not None:
        for k, v in count.items():
            stats[k] = stats.get(k, 0) + v
    return links, parent


def _tile_join(table: pa.Table, cosine: float, axes: dict) -> pa.Table:
    """Links between the blocks of one pair of tiles (or inside one tile)."""
    table = table.sort_by([("tile", "ascending"), ("seq", "ascending")])
    at = np.asarray(table["tile"])
    low, high = at[0], at[-1]
    dim = table["dim"][0].as_py()

    def side(tile: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = table.filter(pa.array(at == tile))
        nodes, weights, vecs = (b"".join(rows[c].to_pylist()) for c in ("nodes", "weights", "vecs"))
        return (np.frombuffer(nodes, np.int64), np.frombuffer(weights, np.int64),
                np.frombuffer(vecs, np.float64).reshape(-1, dim))

    nodes, wa, xa = side(low)
    if low == high:
        links, parent = join_blocks(xa, wa, None, None, cosine, axes)
    else:
        nb, wb, xb = side(high)
        nodes = np.r_[nodes, nb]
        links, parent = join_blocks(xa, wa, xb, wb, cosine, axes)
    hit = np.flatnonzero(links)
    return pa.table({"node": nodes[hit], "links": links[hit], "root": nodes[parent[hit]]})


def _numbered(blocks: DataFrame, tile_bytes: int) -> DataFrame:
    """(block, dim, low, high, part, seq): the tile of every block.

    A tile holds the next ``tile_bytes`` of the blocks of one vector length.  The
    running bytes are sums of whole slices (a row each) plus those inside a slice,
    so no task numbers all blocks; ``seq`` counts tiles over all lengths.
    """
    # the upper bits of a block's number are the partition that wrote it
    sized = blocks.select("block", "dim", "low", "high", F.length("vecs").alias("bytes"),
                          F.shiftright("block", 33).alias("slice"))
    slices = sized.groupBy("dim", "slice").agg(F.sum("bytes").alias("all"))
    before = Window.partitionBy("dim").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("dim", "slice", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("before"))
    upto = Window.partitionBy("dim", "slice").orderBy("block")
    placed = sized.withColumn("upto", F.sum("bytes").over(upto)).join(slices, ["dim", "slice"]) \
        .withColumn("part", F.floor((F.col("before") + F.col("upto") - 1) / F.lit(tile_bytes)))
    # a row per vector length
    lengths = placed.groupBy("dim").agg((F.max("part") + 1).alias("parts"))
    lower = Window.orderBy("dim").rowsBetween(Window.unboundedPreceding, -1)
    lengths = lengths.select("dim", F.coalesce(F.sum("parts").over(lower), F.lit(0)).alias("base"))
    return placed.join(lengths, "dim").select(
        "block", "dim", "low", "high", "part", (F.col("base") + F.col("part")).alias("seq"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    cosine: float = 0.9, block_bytes: int = 2 << 20, max_fit: int = 5_000,
                    tile_bytes: int = 8 << 20) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"))
    good = rows.filter(is_usable(F.col("vec")))
    rest = rows.filter(~is_usable(F.col("vec"))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    reps = cut(good.groupBy("vec").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
               .withColumn("node", F.monotonically_increasing_id()))
    axes = principal_axes(reps, max_fit)
    schema = reps.select("node", "weight", "vec").schema.add("cells", T.ArrayType(T.IntegerType()))
    ordered = reps.select("node", "weight", "vec") \
        .mapInArrow(lambda b: _grid(b, axes, eps), schema) \
        .repartitionByRange("cells", "node").sortWithinPartitions("cells", "node")
    blocks = cut(ordered.select("node", "weight", "vec").mapInArrow(
        lambda b: _pack(b, axes, block_bytes),
        "dim int, nodes binary, weights binary, vecs binary, low array<double>, high array<double>")
        .withColumn("block", F.monotonically_increasing_id()))
    if not blocks.isEmpty():
        numbered = cut(_numbered(blocks, tile_bytes))
        tiles = cut(numbered.groupBy("seq", "dim", "part").agg(
            F.array(*[F.min(F.col("low")[k]) for k in range(LEAD)]).alias("low"),
            F.array(*[F.max(F.col("high")[k]) for k in range(LEAD)]).alias("high")))
        n_tiles = tiles.agg(F.max("seq")).first()[0] + 1
        pairs = interval_pairs(tiles.select("seq", "dim", "low", "high"), n_tiles, eps)
        # a tile's blocks meet the pairs it takes part in
        sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
        places = numbered.select("block", "dim", "part").join(
            tiles.select("dim", "part", F.col("seq").alias("tile")), ["dim", "part"])
        filed = blocks.drop("low", "high", "dim").join(places.drop("part"), "block") \
            .withColumnRenamed("block", "seq")
        found = cut(sides.join(filed, "tile").groupBy("a", "b").applyInArrow(
            lambda t: _tile_join(t, cosine, axes), "node bigint, links bigint, root bigint"))
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        roots = connected_components(found, "node", "root")
        named = reps.select("node", "weight", "least", "vec").join(counts, "node", "left") \
            .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    else:
        named = reps.withColumn("links", F.lit(0).cast("bigint")).withColumn("root", F.col("node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = good.join(named, "vec").select("vec_id", "n_links", "component_id").unionByName(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
