"""Linear panel estimators as Spark jobs.

Rows never leave the executors: the cross-product (Gram) matrix and the
cluster score outer products are added up from partial matrices of the tasks
(``moments`` for within fits); only k x k matrices reach the driver, where numpy
solves them.

Conventions follow ``plm(model = "within")`` + ``vcovHC(type = "sss",
cluster = "group")``: entity effects are swept out by demeaning, the
small-sample factor is G/(G-1) * (N-1)/(N-K) with K the number of estimated
slopes, and t statistics use N - G_entities - K residual degrees of freedom.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plume.stats.moments import Design, Passes
from plume.stats.tdist import t_two_sided_p


@dataclass
class Fit:
    terms: list[str]
    coef: np.ndarray
    vcov: np.ndarray | None
    n_obs: int
    n_groups: int
    df_resid: int
    dropped: list[str] = field(default_factory=list)

    def table(self) -> list[dict]:
        out = []
        for i, t in enumerate(self.terms):
            se = math.sqrt(self.vcov[i, i]) if self.vcov is not None and self.vcov[i, i] >= 0 else float("nan")
            stat = self.coef[i] / se if se and se > 0 else float("nan")
            out.append({"term": t, "estimate": float(self.coef[i]), "std_error": float(se),
                        "statistic": float(stat),
                        "p_value": float(t_two_sided_p(stat, self.df_resid))})
        return out


# --- distributed cross products ------------------------------------------------

def gram(df: DataFrame, cols: list[str], extra: list | None = None):
    """Sum of outer products of the row vectors of ``cols`` (k x k): one partial
    matrix per partition (Arrow batches, numpy), added up by a k-row aggregate.

    With ``extra`` aggregate columns the result is ``(matrix, row)``.
    """
    k = len(cols)

    def part(batches):
        acc = np.zeros((k, k))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns])
            acc += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(acc), pa.list_(pa.float64()))],
                                         ["i", "v"])

    partial = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]) \
        .mapInArrow(part, "i int, v array<double>")
    summed = partial.groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"c{j}") for j in range(k)]).collect()
    g = np.zeros((k, k))
    for r in summed:
        g[r["i"], :] = [r[f"c{j}"] for j in range(k)]
    return (g, df.agg(*extra).collect()[0]) if extra else g


def demean(df: DataFrame, cols: list[str], entity: list[str]) -> DataFrame:
    """Within transform: x - mean(x) over the entity (entity-period grain)."""
    w = Window.partitionBy(*entity)
    return df.withColumns({c: F.col(c) - F.avg(F.col(c)).over(w) for c in cols})


def independent_columns(g: np.ndarray, names: list[str], tol: float = 1e-9,
                        scale: np.ndarray | None = None) -> list[int]:
    """Keep columns in formula order whose residual norm, after projecting
    on the kept ones, is a non-negligible share of their own norm.

    ``scale`` is each column's sum of squares before any transform: a column
    that demeaning reduced to rounding noise (constant within entity) is
    measured against it, not against its own noise."""
    scale = np.diag(g) if scale is None else scale
    keep: list[int] = []
    for j in range(len(names)):
        if g[j, j] <= tol * scale[j] or g[j, j] <= 0:
            continue
        if keep:
            gk = g[np.ix_(keep, keep)]
            b = np.linalg.solve(gk, g[keep, j])
            resid = g[j, j] - g[keep, j] @ b
        else:
            resid = g[j, j]
        if resid > tol * g[j, j] and resid > tol * scale[j]:
            keep.append(j)
    return keep


def _solve(g: np.ndarray, keep: list[int], y_idx: int) -> tuple[np.ndarray, np.ndarray]:
    gk = g[np.ix_(keep, keep)]
    inv = np.linalg.inv(gk)
    return inv @ g[keep, y_idx], inv


# --- estimators --------------------------------------------------------------------

def ols(df: DataFrame, y: str, xs: list[str], intercept: bool = True,
        cluster: str | None = None) -> Fit:
    """Pooled OLS via the Gram matrix (optional intercept, clustered SEs)."""
    data = df.select(y, *xs, *([cluster] if cluster else [])).dropna()
    cols = list(xs)
    if intercept:
        data = data.withColumn("_const", F.lit(1.0))
        cols = ["_const", *cols]
    g, row = gram(data, [*cols, y], [F.count(F.lit(1)).alias("_n")])
    n = int(row["_n"])
    keep = independent_columns(g[:-1, :-1], cols)
    beta, inv = _solve(g, keep, len(cols))
    names = ["(Intercept)" if cols[i] == "_const" else cols[i] for i in keep]
    kept_cols = [cols[i] for i in keep]
    if cluster:
        vc, n_cl = _cluster_vcov(data, y, kept_cols, beta, inv, cluster, n, len(keep))
    else:
        resid = g[-1, -1] - 2 * beta @ g[keep, -1] + beta @ g[np.ix_(keep, keep)] @ beta
        vc, n_cl = inv * resid / max(n - len(keep), 1), 0
    return Fit(names, beta, vc, n, n_cl, n - len(keep),
               [cols[i] for i in range(len(cols)) if i not in keep])


def within(df: DataFrame, y: str, xs: list[str], entity: list[str] | str,
           cluster: str | None = "entity") -> Fit:
    """E1 (+E4, E11): one-way within regression with cluster-robust errors.

    Complete cases only (F7); entity means are taken after the drop, as plm
    does.  ``cluster="entity"`` clusters on the entity key.
    """
    entity = [entity] if isinstance(entity, str) else list(entity)
    if cluster != "entity":
        return _within_other(df, y, xs, entity, cluster)
    return within_sweep(df, [(y, xs)], entity)[0]


def within_sweep(df: DataFrame, models: list[tuple[str, list[str]]], entity: list[str] | str) -> list[Fit]:
    """Within fits (cluster on entity) of several (outcome, regressors), each on
    its own complete cases, in two passes over the rows for all of them."""
    entity = [entity] if isinstance(entity, str) else list(entity)
    cols = list(dict.fromkeys(c for y, xs in models for c in (*xs, y)))
    place = {c: i for i, c in enumerate(cols)}
    passes = Passes(df, entity, cols, [Design(place[y], [place[x] for x in xs]) for y, xs in models])
    moments = passes.moments()
    solved = []
    for (_, xs), m in zip(models, moments):
        keep = independent_columns(m.gram[:-1, :-1], xs, scale=m.raw)
        solved.append((keep, *_solve(m.gram, keep, len(xs))))
    meats = passes.meats([[place[xs[i]] for i in keep] for (_, xs), (keep, _, _) in zip(models, solved)],
                         [beta for _, beta, _ in solved])
    fits = []
    for (_, xs), m, (keep, beta, inv), meat in zip(models, moments, solved, meats):
        g, n, k = m.entities, m.n, len(keep)
        factor = (g / max(g - 1, 1)) * ((n - 1) / max(n - k, 1))
        fits.append(Fit([xs[i] for i in keep], beta, factor * inv @ meat @ inv, n, g, n - g - k,
                        [xs[i] for i in range(len(xs)) if i not in keep]))
    return fits


def _within_other(df: DataFrame, y: str, xs: list[str], entity: list[str], cluster: str | None) -> Fit:
    """Within fit with errors clustered on another column, or without."""
    data = df.select(*entity, y, *xs, *([cluster] if cluster else [])).dropna()
    w = Window.partitionBy(*entity)
    dmc = {f"_d{i}": F.col(c) - F.avg(F.col(c)).over(w) for i, c in enumerate([y, *xs])}
    dm = data.withColumns(dmc).cache()
    dy, dxs = "_d0", [f"_d{i + 1}" for i in range(len(xs))]
    g, row = gram(dm, [*dxs, dy], [
        F.count(F.lit(1)).alias("_n"), F.countDistinct(*entity).alias("_g"),
        *[F.sum(F.col(x) * F.col(x)).alias(f"_ss{i}") for i, x in enumerate(xs)]])
    n, n_ent = int(row["_n"]), int(row["_g"])
    keep = independent_columns(g[:-1, :-1], xs, scale=np.array([float(row[f"_ss{i}"] or 0.0) for i in range(len(xs))]))
    beta, inv = _solve(g, keep, len(xs))
    vc = _cluster_vcov(dm, dy, [dxs[i] for i in keep], beta, inv, [cluster], n, len(keep))[0] if cluster else None
    dm.unpersist()
    return Fit([xs[i] for i in keep], beta, vc, n, n_ent, n - n_ent - len(keep),
               [xs[i] for i in range(len(xs)) if i not in keep])


def _cluster_vcov(dm: DataFrame, y: str, xs: list[str], beta: np.ndarray, inv: np.ndarray,
                  cluster, n: int, k: int):
    """Sandwich with cluster scores s_g = sum_i x_i u_i.

    The scores are one groupBy; the meat sum_g s_g s_g' is a second agg over the
    (clusters x k) score table, so nothing of size G reaches the driver.
    """
    cl = cluster if isinstance(cluster, list) else [cluster]
    fitted = sum((F.lit(float(b)) * F.col(x) for b, x in zip(beta, xs)), F.lit(0.0))
    res = dm.withColumn("_u", F.col(y) - fitted)
    scores = res.groupBy(*cl).agg(*[F.sum(F.col(x) * F.col("_u")).alias(f"s{i}")
                                    for i, x in enumerate(xs)])
    sc = [f"s{i}" for i in range(len(xs))]
    gg = gram(scores.withColumn("_one", F.lit(1.0)), [*sc, "_one"])
    meat, n_cl = gg[:-1, :-1], int(round(gg[-1, -1]))
    factor = (n_cl / max(n_cl - 1, 1)) * ((n - 1) / max(n - k, 1))
    return factor * inv @ meat @ inv, n_cl


def two_way_within(df: DataFrame, y: str, xs: list[str], entity: str, time: str) -> Fit:
    """Entity + time effects, exact for balanced and unbalanced panels.

    Entity means are swept out by one aggregate joined back.  On a balanced
    panel (detected from the counts) time means are swept the same way.
    Otherwise time dummies are carried as regressors, swept by entity too and
    solved with the rest in one Gram matrix; their number is bounded by the
    calendar.  Columns that the sweeps reduce to rounding noise are measured
    against their raw sums of squares and dropped.
    """
    cur = df.select(entity, time, y, *xs).dropna()
    st = cur.agg(F.countDistinct(entity).alias("e"), F.countDistinct(time).alias("t"),
                 F.count(F.lit(1)).alias("n"),
                 F.countDistinct(entity, time).alias("cells")).collect()[0]
    n_ent, n_t = int(st["e"]), int(st["t"])
    balanced = st["n"] == st["cells"] == n_ent * n_t
    dums: list[str] = []
    if not balanced:
        levels = sorted(r[0] for r in cur.select(time).distinct().collect())[1:]
        dums = [f"_t{i}" for i in range(len(levels))]
        cur = cur.select("*", *[(F.col(time) == F.lit(v)).cast("double").alias(d)
                                for d, v in zip(dums, levels)])
    every = [*xs, *dums]
    raw = cur.agg(*[F.sum(F.col(c) * F.col(c)).alias(c) for c in every]).collect()[0]
    for key in (entity, time) if balanced else (entity,):
        means = cur.groupBy(key).agg(*[F.avg(c).alias(f"_m_{c}") for c in [y, *every]])
        cur = cur.join(means, on=key, how="inner") \
            .withColumns({c: F.col(c) - F.col(f"_m_{c}") for c in [y, *every]}) \
            .drop(*[f"_m_{c}" for c in [y, *every]])
    cur = cur.cache()
    g, row = gram(cur, [*every, y], [F.count(F.lit(1)).alias("_n")])
    n = int(row["_n"])
    keep = independent_columns(g[:-1, :-1], every,
                               scale=np.array([float(raw[c] or 0.0) for c in every]))
    beta, inv = _solve(g, keep, len(every))
    kept = [every[i] for i in keep]
    nx = sum(i < len(xs) for i in keep)
    vc, _ = _cluster_vcov(cur, y, kept, beta, inv, [entity], n, nx)
    cur.unpersist()
    df_time = n_t - 1 if balanced else len(keep) - nx
    return Fit(kept[:nx], beta[:nx], vc[:nx, :nx], n, n_ent, n - n_ent - df_time - nx)
