"""Estimators against numpy / closed forms (survey 5: FWL, invariance)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plume.stats import event_study as es
from plume.stats import moments, regress
from plume.stats.tdist import t_cdf, t_quantile, t_two_sided_p


def test_within_fixture(spark):
    rows = [("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, 6.0),
            ("b", 1.0, 11.0), ("b", 2.0, 13.0), ("b", 3.0, 15.0)]
    df = spark.createDataFrame(rows, "e string, x double, y double")
    fit = regress.within(df, "y", ["x"], "e", cluster=None)
    assert abs(fit.coef[0] - 2.0) < 1e-12 and fit.n_groups == 2


def _panel(spark, n_ent=40, n_t=8, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(n_ent):
        fe = rng.normal() * 3
        for t in range(n_t):
            x1, x2 = rng.normal(), rng.normal()
            y = fe + 1.5 * x1 - 0.5 * x2 + rng.normal() * (1 + e % 3)
            rows.append((e, t, x1, x2, y))
    return rows, spark.createDataFrame(rows, "e long, t long, x1 double, x2 double, y double")


def _numpy_within_cluster(rows):
    arr = np.array(rows, dtype=float)
    e = arr[:, 0].astype(int)
    X, y = arr[:, 2:4], arr[:, 4]
    Xd, yd = X.copy(), y.copy()
    for g in np.unique(e):
        m = e == g
        Xd[m] -= X[m].mean(0)
        yd[m] -= y[m].mean()
    XtX = Xd.T @ Xd
    b = np.linalg.solve(XtX, Xd.T @ yd)
    u = yd - Xd @ b
    meat = np.zeros((2, 2))
    for g in np.unique(e):
        s = Xd[e == g].T @ u[e == g]
        meat += np.outer(s, s)
    G, N, K = len(np.unique(e)), len(y), 2
    inv = np.linalg.inv(XtX)
    V = (G / (G - 1)) * ((N - 1) / (N - K)) * inv @ meat @ inv
    return b, np.sqrt(np.diag(V))


def test_within_cluster_matches_numpy(spark):
    rows, df = _panel(spark)
    fit = regress.within(df, "y", ["x1", "x2"], "e")
    b, se = _numpy_within_cluster(rows)
    assert np.allclose(fit.coef, b, atol=1e-10)
    assert np.allclose(np.sqrt(np.diag(fit.vcov)), se, atol=1e-10)


def test_fwl_within_equals_dummy_ols(spark):
    rows, df = _panel(spark, n_ent=6, n_t=5)
    fit = regress.within(df, "y", ["x1", "x2"], "e", cluster=None)
    dummies = df.select("*", *[(F.col("e") == i).cast("double").alias(f"d{i}") for i in range(6)])
    full = regress.ols(dummies, "y", ["x1", "x2", *[f"d{i}" for i in range(6)]], intercept=False)
    assert np.allclose(fit.coef, full.coef[:2], atol=1e-9)


def test_cluster_se_invariant_to_partitioning(spark):
    _, df = _panel(spark)
    a = regress.within(df.repartition(1), "y", ["x1", "x2"], "e")
    b = regress.within(df.repartition(13), "y", ["x1", "x2"], "e")
    assert np.allclose(a.vcov, b.vcov, rtol=1e-9)


def test_collinear_term_is_dropped(spark):
    _, df = _panel(spark)
    df = df.withColumn("x3", F.col("x1") * 2).withColumn("const_in_e", F.col("e").cast("double"))
    fit = regress.within(df, "y", ["x1", "x2", "x3", "const_in_e"], "e")
    assert fit.terms == ["x1", "x2"] and set(fit.dropped) == {"x3", "const_in_e"}


def test_gram_equals_numpy(spark):
    _, df = _panel(spark)
    cols = ["x1", "x2", "y"]
    x = df.select(*cols).toPandas().to_numpy()
    g, row = regress.gram(df, cols, [F.count(F.lit(1)).alias("n")])
    assert np.allclose(g, x.T @ x) and row["n"] == len(x)


def test_two_way_balanced_matches_double_demeaning(spark):
    rows, df = _panel(spark, n_ent=10, n_t=6)
    arr = np.array(rows, dtype=float)
    e, t, x, y = arr[:, 0], arr[:, 1], arr[:, 2], arr[:, 4]

    def dd(v):
        out = v.copy()
        for g in np.unique(e):
            out[e == g] -= v[e == g].mean()
        for g in np.unique(t):
            out[t == g] -= v[t == g].mean()
        return out + v.mean()
    xd, yd = dd(x), dd(y)
    fit = regress.two_way_within(df, "y", ["x1"], "e", "t")
    assert abs(fit.coef[0] - (xd @ yd) / (xd @ xd)) < 1e-9


def test_t_distribution():
    assert abs(t_quantile(0.975, 10) - 2.228138851986274) < 1e-9
    assert abs(t_quantile(0.975, 1e9) - 1.959963984540054) < 1e-6
    assert abs(t_cdf(0.0, 5) - 0.5) < 1e-15
    assert abs(t_two_sided_p(2.228138851986274, 10) - 0.05) < 1e-9
    assert abs(t_cdf(-1.812461122811676, 10) - 0.05) < 1e-9


def test_event_study_table_shape(spark):
    rows = []
    for e in range(30):
        start = 3 + e % 3
        for t in range(1, 9):
            flag = 1 if start <= t <= start + 2 else 0
            rows.append((e, t, flag, math.log1p(10 + e + (5 if flag else 0) + t * 0.1)))
    df = spark.createDataFrame(rows, "e long, t long, flag int, y double")
    from plume.operators.window import event_time
    panel = event_time(df, "flag", "e", "t")
    tab = es.fit_table(spark, panel, es.Spec("m", "y", "weeks_since_start"), "e").collect()
    assert tab[0].term_order == 0 and tab[0].estimate == 0.0
    assert all(r.percent_difference == -r.estimate for r in tab)
    assert tab[1].low <= tab[1].percent_difference <= tab[1].high


def test_welch_matches_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 30), rng.normal(1, 2, 45)
    rows = [(1, "a", float(v)) for v in a] + [(1, "b", float(v)) for v in b]
    df = spark.createDataFrame(rows, "p int, g string, v double")
    r = es.welch_ci(df, "v", "g", "p", "a", "b").collect()[0]
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    dfw = (va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1))
    half = t_quantile(0.975, dfw) * math.sqrt(va + vb)
    assert abs(r.diff - (a.mean() - b.mean())) < 1e-12 and abs(r.df - dfw) < 1e-9
    assert abs(r.ci_high - (a.mean() - b.mean() + half)) < 1e-9


def _naive_within(rows, y, xs):
    """Coefficients, clustered covariance, rows and entities by numpy; rows: dicts."""
    full = [r for r in rows if all(r[c] is not None for c in (y, *xs))]
    ents = sorted({r["e"] for r in full}, key=str)
    z = np.array([[r[c] for c in (*xs, y)] for r in full], float)
    code = np.array([ents.index(r["e"]) for r in full])
    for e in range(len(ents)):
        z[code == e] -= z[code == e].mean(0)
    x, v = z[:, :-1], z[:, -1]
    inv = np.linalg.inv(x.T @ x)
    beta = inv @ x.T @ v
    s = np.array([(x[code == e] * (v - x @ beta)[code == e][:, None]).sum(0) for e in range(len(ents))])
    n, g, k = len(full), len(ents), len(xs)
    return beta, g / (g - 1) * (n - 1) / (n - k) * inv @ s.T @ s @ inv, n, g


def _gappy(spark, parts):
    """A panel with gaps in every column and one entity at a third of the rows."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        e = None if i % 11 == 0 else 0 if i % 3 == 0 else int(rng.integers(1, 40))
        x = rng.normal(size=3) + (e or 0)
        row = dict(e=e, y=float(3 + x @ [1, -2, 0.5] + rng.normal()), x1=float(x[0]), x2=float(x[1]), x3=float(x[2]))
        for c, every in (("x2", 7), ("x3", 4), ("y", 13)):
            if i % every == 0:
                row[c] = None
        rows.append(row)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "e int, y double, x1 double, x2 double, x3 double")
    return rows, df.repartition(parts)


@pytest.mark.parametrize("parts, chunk", [(1, 65_536), (6, 65_536), (3, 50)])
def test_sweep_of_models_with_other_gaps_against_numpy(spark, parts, chunk, monkeypatch):
    monkeypatch.setattr(moments, "CHUNK", chunk)
    rows, df = _gappy(spark, parts)
    models = [("y", ["x1"]), ("y", ["x1", "x2"]), ("y", ["x3", "x1", "x2"]), ("x3", ["x2"])]
    for (y, xs), fit in zip(models, regress.within_sweep(df, models, "e")):
        beta, vcov, n, g = _naive_within(rows, y, xs)
        assert (fit.terms, fit.n_obs, fit.n_groups) == (xs, n, g)
        assert np.allclose(fit.coef, beta, atol=1e-10) and np.allclose(fit.vcov, vcov, atol=1e-10)


def test_a_hot_entity_is_many_summaries(spark):
    _, df = _gappy(spark, 8)
    p = moments.Passes(df, ["e"], ["x1", "x2", "y"], [moments.Design(2, [0, 1])])
    hot = p.summaries.filter("i is null and entity like '%\"0\"%'")
    assert hot.select("n").agg(F.max("n")).first()[0] < 60 and hot.count() > 8


def test_models_without_rows_or_terms(spark):
    _, df = _gappy(spark, 2)
    df = df.withColumn("none", F.lit(None).cast("double")).withColumn("flat", F.col("e") * 1.0)
    empty, flat, plain = regress.within_sweep(df, [("y", ["none"]), ("y", ["flat"]), ("y", ["x1"])], "e")
    assert empty.n_obs == 0 and empty.dropped == ["none"] and flat.dropped == ["flat"]
    assert plain.terms == ["x1"]
    none = regress.within_sweep(df.filter("false"), [("y", ["x1"])], "e")[0]
    assert (none.n_obs, none.n_groups, none.terms) == (0, 0, [])


def test_within_sweep_equals_separate_fits(spark):
    _, df = _panel(spark)
    fits = regress.within_sweep(df, [("y", ["x1"]), ("y", ["x1", "x2"])], "e")
    for f, xs in zip(fits, [["x1"], ["x1", "x2"]]):
        one = regress.within(df, "y", xs, "e")
        assert np.allclose(f.coef, one.coef, atol=1e-12)
        assert np.allclose(f.vcov, one.vcov, atol=1e-12) and f.n_groups == one.n_groups


def test_wide_design_matches_numpy(spark):
    """Fifteen regressors."""
    rng = np.random.default_rng(11)
    k, rows = 15, []
    for e in range(25):
        fe = rng.normal()
        for t in range(10):
            x = rng.normal(size=k)
            rows.append((e, *x.tolist(), float(fe + x @ np.linspace(-1, 1, k) + rng.normal())))
    names = [f"x{i}" for i in range(k)]
    df = spark.createDataFrame(rows, ["e", *names, "y"])
    fit = regress.within(df, "y", names, "e")
    arr = np.array(rows, dtype=float)
    e, X, y = arr[:, 0].astype(int), arr[:, 1:k + 1], arr[:, -1]
    Xd, yd = X.copy(), y.copy()
    for g in np.unique(e):
        Xd[e == g] -= X[e == g].mean(0)
        yd[e == g] -= y[e == g].mean()
    b = np.linalg.solve(Xd.T @ Xd, Xd.T @ yd)
    u = yd - Xd @ b
    meat = sum(np.outer(Xd[e == g].T @ u[e == g], Xd[e == g].T @ u[e == g]) for g in np.unique(e))
    inv = np.linalg.inv(Xd.T @ Xd)
    G, N = 25, len(y)
    V = (G / (G - 1)) * ((N - 1) / (N - k)) * inv @ meat @ inv
    assert fit.n_obs == N and fit.n_groups == G
    assert np.allclose(fit.coef, b, atol=1e-9) and np.allclose(fit.vcov, V, atol=1e-9)
