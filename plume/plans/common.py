"""Shared stages of the driver queries (stand-in roles: user = county,
event_type = NAICS / block group, ts date = day, value = measure)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.functions.calendar import week_start
from plume.functions.rsem import exact_mean, sum_skip

# Fixed study window of the stand-in panel (2024 starts on a Monday)
STUDY_START = "2024-01-01"
STUDY_END = "2024-01-30"
BASE_WEEK = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Round half up to 6 decimals with plain double arithmetic, so the DuckDB
    oracle (``floor(x * 1e6 + 0.5) / 1e6``) gives bit-identical results."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)


def user_daily(events: DataFrame) -> DataFrame:
    """Entity-day grain: the block-group -> county-day roll-up (A1, A3, A5)."""
    return events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"),
        sum_skip("value", real=True).alias("total_value"),
        exact_mean("value").alias("mean_value"),
        F.max(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("error_flag"),
    )


def user_weekly(daily: DataFrame) -> DataFrame:
    """Entity-week grain from the entity-day grain (A9, T3): second roll-up on
    already-combined rows; the week label is a scalar, no window."""
    return daily.groupBy("user_id", week_start("day").alias("week_start")).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sum("n_events").alias("n_events"),
        sum_skip("total_value", real=True).alias("total_value"),
        exact_mean("mean_value").alias("mean_daily_mean"),
    )


def _files_key(spark: SparkSession, inputs: dict[str, DataFrame]) -> str:
    """Names, sizes and times of the files behind some tables; no content is read."""
    paths = sorted({unquote(f) for df in inputs.values() for f in df.inputFiles()})
    if not paths:
        return "none"
    files = spark.read.format("binaryFile").load(paths)
    one = F.pmod(F.xxhash64("path", "length", "modificationTime"), F.lit(1 << 40))
    return repr(tuple(files.agg(F.count(F.lit(1)), F.sum(one)).collect()[0]))


def _written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has ended: its success marker is there."""
    sc = spark.sparkContext
    marker = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(sc._jsc.hadoopConfiguration()).exists(marker)


def materialized(spark: SparkSession, name: str, inputs: dict[str, DataFrame],
                 build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> DataFrame:
    """Build a table once per application and read it back afterwards.

    This mirrors the reference, whose analysis notebooks read the written
    panel instead of rebuilding it.  The table lives in the shared checkpoint
    folder under a key of the application id and of the input files' names,
    sizes and times, so it is never reused across applications, for other
    folders or after the inputs change.  A folder without a success marker is
    written anew.
    """
    from plume.session import scratch_path
    key = hashlib.sha1(repr((name, spark.sparkContext.applicationId,
                             _files_key(spark, inputs))).encode())
    path = scratch_path(spark, "tables", f"{name}-{key.hexdigest()[:16]}")
    if not _written(spark, path):
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return spark.read.parquet(path)
