"""Event-time base levels, stars, hot values in quantiles, written tables."""

import os

import numpy as np
from pyspark.sql import functions as F

from plume.operators import rank
from plume.plans.common import materialized
from plume.stats import event_study as es
from plume.stats.tdist import stars


def test_base_is_the_lowest_level_of_the_complete_rows(spark):
    """lag1 is null in each entity's first week, so week -3 leaves that design."""
    rng = np.random.default_rng(3)
    rows = [(e, w, float(rng.normal() + 0.5 * w), None if w == -3 else float(rng.normal()))
            for e in range(8) for w in range(-3, 3)]
    panel = spark.createDataFrame(rows, "entity int, week int, y double, lag1 double")
    specs = [es.Spec("plain", "y", "week"), es.Spec("lags", "y", "week", ["lag1"])]
    got = es.sweep(spark, panel, specs, "entity").collect()
    terms = {m: [r["term"] for r in got if r["model"] == m] for m in ("plain", "lags")}
    assert terms["plain"] == [f"week{w}" for w in range(-3, 3)]
    assert terms["lags"] == [f"week{w}" for w in range(-2, 3)] + ["lag1"]

    full = [r for r in rows if r[3] is not None]
    entity = np.array([r[0] for r in full])
    x = np.column_stack([*[np.array([float(r[1] == w) for r in full]) for w in range(-1, 3)],
                         [r[3] for r in full], *[(entity == e).astype(float) for e in range(8)]])
    beta = np.linalg.lstsq(x, np.array([r[2] for r in full]), rcond=None)[0]
    mine = {r["term"]: r["estimate"] for r in got if r["model"] == "lags"}
    np.testing.assert_allclose([mine[t] for t in terms["lags"][1:]], beta[:5], atol=1e-8)
    alone = es.fit_table(spark, panel, specs[1], "entity").collect()
    assert [r["term"] for r in alone] == terms["lags"]


def test_stars_follow_normal_quantiles():
    assert [stars(x) for x in (1.6, -1.7, 1.97, -2.6, float("nan"), None)] == ["", "*", "**", "***", "", ""]


def test_a_value_held_by_most_rows_is_one_row(spark):
    x = np.r_[np.zeros(9_000), np.arange(1, 1_001)]
    df = spark.range(len(x)).select(F.when(F.col("id") < 9_000, 0.0)
                                    .otherwise(F.col("id") - 8_999.0).alias("x"))
    probs = [0.0, 0.25, 0.9, 0.95, 1.0]
    got = rank.quantiles(df, "x", probs, names=list("abcde")).collect()[0]
    np.testing.assert_allclose(list(got), np.quantile(x, probs))
    assert list(rank.quantiles(df.filter("x < 0"), "x", [0.5], names=["m"]).collect()[0]) == [None]


def test_written_table_follows_its_input_files(spark, tmp_path):
    def built(folder, values):
        path = str(tmp_path / folder)
        spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.mode("overwrite").parquet(path)
        df = spark.read.parquet(path)
        out = materialized(spark, "sum_v", {"t": df}, lambda: df.agg(F.sum("v").alias("s")))
        return out.collect()[0]["s"]

    assert built("a", [1, 2]) == 3
    assert built("b", [10, 20]) == 30      # another folder, as many rows
    assert built("a", [5, 5]) == 10        # the same folder, written anew


def test_a_table_without_success_marker_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).write.parquet(path)
    df = spark.read.parquet(path)
    calls = []

    def build():
        calls.append(1)
        return df

    first = materialized(spark, "copy", {"t": df}, build)
    materialized(spark, "copy", {"t": df}, build)
    assert len(calls) == 1
    folder = os.path.dirname(first.inputFiles()[0].removeprefix("file://"))
    os.remove(f"{folder}/_SUCCESS")
    assert materialized(spark, "copy", {"t": df}, build).count() == 3
    assert len(calls) == 2
