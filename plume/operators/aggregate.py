"""Aggregation operators beyond a plain groupBy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.functions.rsem import exact_mean, null_share
from plume.operators.shape import union_all


def coverage_keys(df: DataFrame, entity: list[str], day: str, n_days: int | None = None,
                  reference: DataFrame | None = None) -> DataFrame:
    """Entities observed on exactly the required number of distinct days.

    ``n_days`` fixes the count (the reference's 128); with ``reference`` the
    count is the number of distinct days in that frame (a 1-row aggregate).
    """
    per = df.groupBy(*entity).agg(F.countDistinct(day).alias("_days"))
    if n_days is not None:
        return per.filter(F.col("_days") == n_days).select(*entity)
    total = (reference or df).agg(F.countDistinct(day).alias("_need"))
    # 1 row by construction: safe to broadcast
    return per.join(F.broadcast(total), F.col("_days") == F.col("_need"), "inner") \
        .select(*entity)


def full_coverage(df: DataFrame, entity: list[str], day: str, n_days: int | None = None) -> DataFrame:
    """Drop entities lacking full day coverage (anti join on the others)."""
    keys = df.select(*entity).distinct()
    good = coverage_keys(df, entity, day, n_days)
    bad = keys.join(good, on=entity, how="left_anti")
    return df.join(bad, on=entity, how="left_anti")


def two_grain(df: DataFrame, coarse: list[str], extra: list[str], aggs: dict,
              resum: dict) -> DataFrame:
    """Aggregate at (coarse + extra), then roll the fine table up to
    ``coarse`` (sums are additive, so the raw rows are read once) and stack
    both grains by name; the coarse rows carry null ``extra`` columns."""
    fine = df.groupBy(*coarse, *extra).agg(*[v.alias(k) for k, v in aggs.items()])
    coarse_df = fine.groupBy(*coarse).agg(*[v.alias(k) for k, v in resum.items()])
    return union_all([fine, coarse_df])


def column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """R's ``summary()`` per column - min, quartiles, mean, max, NAs.

    The columns are stacked into one long (column, value) frame, so a single
    aggregate and a single distributed ranking (exact type-7 quartiles) cover
    all of them; each column is a group that the ranking may split across
    many tasks.
    """
    from plume.operators.rank import quantiles
    from plume.operators.shape import unpivot_long

    long = unpivot_long(df, [], cols, "column", "value", cast="double")
    stats = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("min"), exact_mean("value").alias("mean"),
        F.max("value").alias("max"), F.sum(F.col("value").isNull().cast("long")).alias("nulls"),
        null_share("value").alias("null_share"))
    qs = quantiles(long, "value", [0.25, 0.5, 0.75], ["column"], names=["q1", "median", "q3"])
    out = stats.join(qs, "column", "left")
    return out.select("column", "n", "min", "q1", "median", "mean", "q3", "max", "nulls",
                      "null_share")
