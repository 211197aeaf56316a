"""Event-study tables and the per-period tests.

The panel stays a DataFrame; only the event-time levels (bounded by the
calendar length) and the k x k fit results come to the driver.  Output
tables are tiny (one row per coefficient) and go back out as DataFrames.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plume.operators.shape import one_hot
from plume.stats.regress import within, within_sweep
from plume.stats.tdist import stars, t_quantile

BAND = 1.96  # fixed value: half-width of the reported interval in standard errors

TABLE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("term_order", T.IntegerType()),
    T.StructField("term", T.StringType()),
    T.StructField("estimate", T.DoubleType()),
    T.StructField("std_error", T.DoubleType()),
    T.StructField("statistic", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()),
    T.StructField("stars", T.StringType()),
    T.StructField("percent_difference", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("event_week", T.LongType()),  # null for other regressors
])


@dataclass
class Spec:
    """One model of the sweep."""
    name: str
    outcome: str
    event_col: str
    controls: list[str] = field(default_factory=list)


def event_levels(df: DataFrame, event_col: str, designs: list[list[str]]) -> list[tuple[int, list]]:
    """Per design (its outcome and controls): how many rows are complete, and
    the event levels among those rows, all in one pass."""
    aggs = []
    for i, cols in enumerate(designs):
        complete = reduce(and_, [F.col(c).isNotNull() for c in (event_col, *cols)])
        aggs += [F.count(F.when(complete, 1)).alias(f"n{i}"),
                 F.collect_set(F.when(complete, F.col(event_col))).alias(f"levels{i}")]
    row = df.agg(*aggs).collect()[0]
    return [(row[f"n{i}"], sorted(row[f"levels{i}"])) for i in range(len(designs))]


def _levels(df: DataFrame, specs: list[Spec]) -> list[list]:
    """The event levels among each model's complete rows, in one pass."""
    aggs = []
    for i, sp in enumerate(specs):
        complete = reduce(and_, [F.col(c).isNotNull() for c in (sp.event_col, sp.outcome, *sp.controls)])
        aggs.append(F.collect_set(F.when(complete, F.col(sp.event_col))).alias(f"levels{i}"))
    row = df.agg(*aggs).first()
    return [sorted(row[f"levels{i}"]) for i in range(len(specs))]


def event_dummies(df: DataFrame, event_col: str, levels: list) -> tuple[DataFrame, list[str], str]:
    """Factor expansion of event time; the lowest level is the omitted base.

    ``levels`` are those of the design's complete rows: lags and leads empty
    the lowest ones, and a base without rows would make the dummies add up to
    a constant.  Rows with null event time keep null dummies and so leave the
    fit (K19).
    """
    if not levels:
        return df, [], ""
    name = event_col + "{level}"
    out = one_hot(df, event_col, levels[1:], name=name)
    return out, [name.format(level=lv) for lv in levels[1:]], name.format(level=levels[0])


def _table(spark: SparkSession, name: str, fit, base: str, band: float, weeks: dict[str, int]) -> DataFrame:
    rows = [{"term": base, "estimate": 0.0, "std_error": 0.0, "statistic": 0.0,
             "p_value": 0.0}] + fit.table()
    out = []
    for i, r in enumerate(rows):
        se = r["std_error"]
        pdiff = -r["estimate"]
        out.append((name, i, r["term"], r["estimate"], se, r["statistic"], r["p_value"],
                    stars(r["statistic"]) if i else "", pdiff,
                    pdiff - band * se if se == se else None,
                    pdiff + band * se if se == se else None, weeks.get(r["term"])))
    return spark.createDataFrame(out, TABLE_SCHEMA)


def fit_table(spark: SparkSession, panel: DataFrame, spec: Spec, entity: str,
              band: float = BAND) -> DataFrame:
    """E1+E4+E5+E10+M9 for one spec: coefficient table with the omitted base
    row re-added first (term_order 0), percent difference = -estimate and a
    +-band * se interval."""
    (_, levels), = event_levels(panel, spec.event_col, [[spec.outcome, *spec.controls]])
    data, dummies, base = event_dummies(panel, spec.event_col, levels)
    xs = [*dummies, *spec.controls]
    fit = within(data.dropna(subset=[spec.event_col]), spec.outcome, xs, entity)
    return _table(spark, spec.name, fit, base, band, _weeks(spec.event_col, levels))


def _weeks(event_col: str, levels: list) -> dict[str, int]:
    """Term -> event week."""
    return {f"{event_col}{lv}": int(lv) for lv in levels}


def sweep(spark: SparkSession, panel: DataFrame, specs: list[Spec], entity: str,
          keep_rows: tuple[int, int] | None = None, band: float = BAND,
          weeks: tuple[int, int] | None = None) -> DataFrame:
    """E7 (+F6): fit every spec on one cached panel and stack the tables;
    ``keep_rows`` keeps term_order in [a, b] (the reference's row filter);
    ``weeks`` (H12) keeps the terms of event weeks in [a, b], the same weeks in
    every model whatever its base.

    All models are fitted from two passes over the panel, each on its own
    complete cases (``regress.within_sweep``).
    """
    levels = _levels(panel, specs)
    data = panel
    for ev in dict.fromkeys(sp.event_col for sp in specs):
        every = sorted({lv for sp, found in zip(specs, levels) if sp.event_col == ev for lv in found})
        data = one_hot(data, ev, every, name=ev + "{level}")
    models = [(sp.outcome, [*[f"{sp.event_col}{lv}" for lv in found[1:]], *sp.controls])
              for sp, found in zip(specs, levels)]
    fits = within_sweep(data, models, entity)
    tables = {sp.name: _table(spark, sp.name, fit, f"{sp.event_col}{found[0]}" if found else "", band,
                              _weeks(sp.event_col, found))
              for sp, found, fit in zip(specs, levels, fits)}
    ordered = [tables[sp.name] for sp in specs]
    out = ordered[0]
    for t in ordered[1:]:
        out = out.unionByName(t)
    if keep_rows:
        out = out.filter(F.col("term_order").between(*keep_rows))
    if weeks:
        out = out.filter(F.col("event_week").between(*weeks))
    return out


# --- E8: per-period slope sweep ------------------------------------------------

def slope_sweep(df: DataFrame, y: str, x: str, period: str) -> DataFrame:
    """One regression per period as grouped moments (no driver loop)."""
    return df.groupBy(period).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_count(F.col(y), F.col(x)).alias("n_obs"))


# --- E9: Welch two-sample interval per period -----------------------------------

def welch(df: DataFrame, value: str, group: str, period: str, a, b) -> DataFrame:
    """Per period: mean difference (a - b), Welch standard error and df."""
    m = df.groupBy(period).agg(
        F.count(F.when(F.col(group) == a, F.col(value))).alias("n_a"),
        F.avg(F.when(F.col(group) == a, F.col(value))).alias("mean_a"),
        F.var_samp(F.when(F.col(group) == a, F.col(value))).alias("var_a"),
        F.count(F.when(F.col(group) == b, F.col(value))).alias("n_b"),
        F.avg(F.when(F.col(group) == b, F.col(value))).alias("mean_b"),
        F.var_samp(F.when(F.col(group) == b, F.col(value))).alias("var_b"))
    va = F.col("var_a") / F.col("n_a")
    vb = F.col("var_b") / F.col("n_b")
    return m.withColumns({
        "diff": F.col("mean_a") - F.col("mean_b"),
        "se": F.sqrt(va + vb),
        "df": F.try_divide((va + vb) * (va + vb),
                           va * va / (F.col("n_a") - 1) + vb * vb / (F.col("n_b") - 1)),
    })


@F.pandas_udf(T.DoubleType())
def _t975(df_: pd.Series) -> pd.Series:
    return df_.map(lambda d: t_quantile(0.975, d) if d and d == d and d > 0 else math.nan)


def welch_ci(df: DataFrame, value: str, group: str, period: str, a, b) -> DataFrame:
    """E9 with the 95% interval (t quantile per row, Arrow-batched)."""
    w = welch(df, value, group, period, a, b).withColumn("_tq", _t975(F.col("df")))
    return w.withColumns({"ci_low": F.col("diff") - F.col("_tq") * F.col("se"),
                          "ci_high": F.col("diff") + F.col("_tq") * F.col("se")}).drop("_tq")
