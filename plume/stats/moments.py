"""Within fits from mergeable moments.

No window and no shuffle of rows.  A task cuts its rows into chunks; in a chunk
the rows of one entity with one pattern of missing columns are summarised by
their number, their means and cross products about these means.  Summaries merge
by the pairwise update

    products = sum of products + sum of n (mean - common mean)(mean - common mean)'

so an entity that holds a third of all rows is many summaries from many tasks.
Cross products are kept per pattern (not per entity): a model adds those of the
patterns that miss none of its columns, so models with different complete cases
share one pass.  Means are kept per entity and pattern, a row each, and meet by
entity for the between part of the update.  A second pass over the rows, with the
coefficients known, sums each entity's scores in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.session import ensure_checkpoint_dir

#: rows summarised together in a task
CHUNK = 65_536


@dataclass
class Design:
    """One model: outcome and regressors, as column numbers."""

    y: int
    xs: list[int]

    @property
    def columns(self) -> np.ndarray:
        return np.array([*self.xs, self.y])


def _rows(df: DataFrame, entity: list[str], cols: list[str]) -> DataFrame:
    """``entity`` as one text key (null-safe) and the columns as doubles."""
    return df.select(F.to_json(F.struct(*[F.col(e).cast("string").alias(f"e{i}") for i, e in enumerate(entity)]))
                     .alias("entity"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])


class _Chunk:
    """Rows sorted by (entity, pattern), with their means taken off."""

    def __init__(self, table: pa.Table, k: int):
        x = np.column_stack([table[f"c{i}"].to_numpy(zero_copy_only=False).astype(float) for i in range(k)])
        lost = np.isnan(x)
        bits = np.packbits(lost, axis=1)
        patterns, of = np.unique(bits, axis=0, return_inverse=True)
        code, names = pd.factorize(np.array(table["entity"].to_pylist(), dtype=object))
        group = code.astype(np.int64) * len(patterns) + of.ravel()
        order = np.argsort(group, kind="stable")
        x, group = np.where(lost, 0.0, x)[order], group[order]
        self.start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        self.n = np.diff(np.r_[self.start, len(group)])
        self.mean = np.add.reduceat(x, self.start) / self.n[:, None]
        self.x = x
        self.centred = x - np.repeat(self.mean, self.n, axis=0)
        self.entity = names[group[self.start] // len(patterns)]
        self.pattern_no = group[self.start] % len(patterns)
        self.patterns = [p.tobytes().hex() for p in patterns]

    def rows_of(self, groups: np.ndarray) -> np.ndarray:
        """Mask of the rows of some groups."""
        return np.repeat(groups, self.n)


def _chunks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[_Chunk]:
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= CHUNK:
            yield _Chunk(pa.Table.from_batches(held), k)
            held, n = [], 0
    if held:
        yield _Chunk(pa.Table.from_batches(held), k)


def _uses(pattern: str, columns: np.ndarray, k: int) -> bool:
    """Whether rows of a pattern miss none of the columns."""
    lost = np.unpackbits(np.frombuffer(bytes.fromhex(pattern), np.uint8))[:k]
    return not lost[columns].any()


_SUMMARY = "entity string, pattern string, n bigint, i int, v array<double>"
_SUMMARY_ARROW = pa.schema([("entity", pa.string()), ("pattern", pa.string()), ("n", pa.int64()), ("i", pa.int32()),
                            ("v", pa.list_(pa.float64()))])


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def summaries(rows: DataFrame, k: int) -> DataFrame:
    """Means per (entity, pattern) (``i`` null), and per task and pattern the k
    rows of the products about the means (``i`` 0..k-1) and the raw sums of
    squares (``i`` = k)."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products: dict[str, np.ndarray] = {}
        for c in _chunks(batches, k):
            yield _batch([list(c.entity), [c.patterns[p] for p in c.pattern_no], c.n, [None] * len(c.n),
                          list(c.mean)], _SUMMARY_ARROW)
            for p, name in enumerate(c.patterns):
                on = c.rows_of(c.pattern_no == p)
                z = c.centred[on]
                got = np.vstack([z.T @ z, (c.x[on] ** 2).sum(0)])
                products[name] = products.get(name, 0.0) + got
        for name, m in products.items():
            yield _batch([[None] * (k + 1), [name] * (k + 1), [0] * (k + 1), range(k + 1), list(m)], _SUMMARY_ARROW)

    return rows.mapInArrow(part, _SUMMARY)


def _by_entity(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Whole entities, from batches sorted by entity."""
    held = None
    for b in batches:
        t = b.to_pandas()
        t = t if held is None else pd.concat([held, t])
        if not len(t):
            continue
        last = t["entity"].iloc[-1]
        done, held = t[t["entity"] != last], t[t["entity"] == last]
        if len(done):
            yield done
    if held is not None and len(held):
        yield held


_SUMS = pa.schema([("model", pa.int32()), ("i", pa.int32()), ("v", pa.list_(pa.float64()))])


def _matrices(parts: DataFrame, work, width: int) -> dict[int, np.ndarray]:
    """Sum over all entities of the matrices that ``work(frame)`` gives per model
    for the summaries of whole entities."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for frame in _by_entity(batches):
            for m, matrix in work(frame).items():
                total[m] = total.get(m, 0.0) + matrix
        for m, matrix in total.items():
            pad = np.zeros((len(matrix), width))
            pad[:, :matrix.shape[1]] = matrix
            yield _batch([[m] * len(pad), range(len(pad)), list(pad)], _SUMS)

    sums = parts.repartition("entity").sortWithinPartitions("entity") \
        .mapInArrow(part, "model int, i int, v array<double>")
    out: dict[int, dict[int, np.ndarray]] = {}
    for r in _added(sums, ["model", "i"], width):
        out.setdefault(r["model"], {})[r["i"]] = np.array(r["v"])
    return {m: np.stack([rows[i] for i in range(len(rows))]) for m, rows in out.items()}


def _added(df: DataFrame, keys: list[str], width: int) -> list:
    """The arrays ``v`` of equal keys added up (a row a key comes to the driver)."""
    return df.groupBy(*keys).agg(F.array(*[F.sum(F.col("v")[j]) for j in range(width)]).alias("v")).collect()


def _spread(frame: pd.DataFrame, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(n, mean minus the entity's mean) of each summary, and the entities."""
    n = frame["n"].to_numpy().astype(float)
    code, names = pd.factorize(frame["entity"])
    all_n = np.bincount(code, n)
    own = np.column_stack([np.bincount(code, n * mean[:, j]) for j in range(mean.shape[1])]) / all_n[:, None]
    return n, mean - own[code], len(names)


@dataclass
class Moments:
    """Of one model: products of the demeaned columns (regressors, then the
    outcome), raw sums of squares of the regressors, rows, entities."""

    gram: np.ndarray
    raw: np.ndarray
    n: int
    entities: int


class Passes:
    """The two passes over the rows of several models."""

    def __init__(self, df: DataFrame, entity: list[str], cols: list[str], designs: list[Design]):
        ensure_checkpoint_dir(df.sparkSession)
        self.k, self.designs = len(cols), designs
        # read by both passes: the same rows, whatever comes before them
        self.rows = _rows(df, entity, cols).checkpoint(eager=True)
        self.summaries = summaries(self.rows, self.k).checkpoint(eager=True)

    def moments(self) -> list[Moments]:
        k, designs = self.k, self.designs
        products: dict[str, np.ndarray] = {}
        for r in _added(self.summaries.filter("i is not null"), ["pattern", "i"], k):
            products.setdefault(r["pattern"], np.zeros((k + 1, k)))[r["i"]] = r["v"]

        def between(frame: pd.DataFrame) -> dict[int, np.ndarray]:
            out = {}
            mean = np.stack(frame["v"].to_numpy())
            use = {p: [_uses(p, d.columns, k) for d in designs] for p in frame["pattern"].unique()}
            for m, d in enumerate(designs):
                on = frame["pattern"].map(lambda p, m=m: use[p][m]).to_numpy().astype(bool)
                if on.any():
                    n, off, entities = _spread(frame[on], mean[on][:, d.columns])
                    out[m] = np.vstack([(off * n[:, None]).T @ off, np.full(len(d.columns), n.sum()),
                                        np.full(len(d.columns), float(entities))])
            return out

        apart = _matrices(self.summaries.filter("i is null").select("entity", "pattern", "n", "v"), between, k)
        out = []
        for m, d in enumerate(designs):
            c, w = d.columns, len(d.columns)
            used = [x for p, x in products.items() if _uses(p, c, k)]
            gram = sum((x[:-1][np.ix_(c, c)] for x in used), np.zeros((w, w)))
            raw = sum((x[-1][c[:-1]] for x in used), np.zeros(w - 1))
            got = apart.get(m, np.zeros((w + 2, k)))[:, :w]
            out.append(Moments(gram + got[:w], raw, int(round(got[w, 0])), int(round(got[w + 1, 0]))))
        return out

    def meats(self, kept: list[list[int]], betas: list[np.ndarray]) -> list[np.ndarray]:
        """Sum over entities of the outer product of their scores, per model."""
        k, designs = self.k, self.designs
        width = 2 * max((len(x) for x in kept), default=0) + 1

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for c in _chunks(batches, k):
                for m, (d, xs, beta) in enumerate(zip(designs, kept, betas)):
                    use = np.array([_uses(p, d.columns, k) for p in c.patterns])[c.pattern_no]
                    if not use.any():
                        continue
                    on = c.rows_of(use)
                    z = c.centred[on][:, xs]
                    score = np.add.reduceat(z * (c.centred[on][:, d.y] - z @ beta)[:, None],
                                            np.r_[0, np.cumsum(c.n[use])[:-1]])
                    v = np.column_stack([score, c.mean[use][:, xs], c.mean[use][:, d.y]])
                    yield _batch([list(c.entity[use]), [str(m)] * len(v), c.n[use], [m] * len(v), list(v)],
                                 _SUMMARY_ARROW)

        def outer(frame: pd.DataFrame) -> dict[int, np.ndarray]:
            out = {}
            for m, part_ in frame.groupby("i"):
                w, beta = len(kept[m]), betas[m]
                v = np.stack(part_["v"].to_numpy())
                n, off, _ = _spread(part_, v[:, w:2 * w + 1])
                score = v[:, :w] + (n * (off[:, w] - off[:, :w] @ beta))[:, None] * off[:, :w]
                code, _ = pd.factorize(part_["entity"])
                s = np.column_stack([np.bincount(code, score[:, j]) for j in range(w)]) if w else np.zeros((1, 0))
                out[int(m)] = s.T @ s
            return out

        parts = self.rows.mapInArrow(part, _SUMMARY)
        got = _matrices(parts.select("entity", "n", "i", "v"), outer, max(1, width // 2))
        return [got.get(m, np.zeros((len(x), len(x))))[:len(x), :len(x)] if len(x) else np.zeros((0, 0))
                for m, x in enumerate(kept)]
