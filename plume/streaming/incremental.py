"""Incremental file arrival (survey 2.14): one raw file per day (devices) or
per week (POI patterns) lands in a folder; each trigger rolls up only the
dates it touched.

Design: a file-source stream (``trigger(availableNow=True)``) feeds
``foreachBatch``.  Each micro-batch

1. writes its raw rows to a bronze table under ``batch_id=<id>`` (overwrite
   of that one folder, so a retried batch is idempotent), partitioned by
   date;
2. re-aggregates the touched dates from *all* bronze batches (partition
   pruning on the date column), so a date split across files or batches is
   still complete;
3. overwrites just those date partitions of the silver table (dynamic
   partition overwrite).

Coverage (M8) and the attrition base (M1) need the whole date range: they are
stream state in ``plume.streaming.coverage``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plume.functions import calendar as cal
from plume.functions import rsem
from plume.session import scratch_path
from plume.sources import schemas
from plume.sources.mobility import visitor_split


def _rollup_stream(spark: SparkSession, source_dir: str, schema: StructType, bronze_dir: str,
                   silver_dir: str, date_col: str, prepare: Callable[[DataFrame], DataFrame],
                   rollup: Callable[[DataFrame], DataFrame], checkpoint: str | None = None,
                   max_files: int = 32):
    stream = (spark.readStream.schema(schema).option("header", True)
              .option("maxFilesPerTrigger", max_files).csv(source_dir))

    def batch(df: DataFrame, batch_id: int) -> None:
        rows = prepare(df)
        if rows.isEmpty():
            return
        (rows.write.mode("overwrite").partitionBy(date_col)
         .parquet(f"{bronze_dir}/batch_id={batch_id}"))
        touched = [r[0] for r in rows.select(date_col).distinct().collect()]  # dates: bounded
        mine = F.col(date_col).isin([d for d in touched if d is not None])
        if None in touched:  # rows with an unreadable date are a group of their own
            mine = mine | F.col(date_col).isNull()
        bronze = spark.read.parquet(bronze_dir).filter(mine)
        (rollup(bronze).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(date_col).parquet(silver_dir))

    ckpt = checkpoint or scratch_path(spark, "streams", silver_dir.strip("/").replace("/", "_"))
    return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


# --- device distancing: stateless county-day roll-up -------------------------------

def _device_rows(df: DataFrame) -> DataFrame:
    bg = rsem.zpad("origin_census_block_group", 12)
    return df.select(F.substring(bg, 1, 5).alias("county_fips"),
                     cal.iso_prefix_date("date_range_start").alias("date"),
                     "device_count", "completely_home_device_count", "candidate_device_count",
                     "median_home_dwell_time", "median_non_home_dwell_time")


def _device_rollup(rows: DataFrame) -> DataFrame:
    home = "completely_home_device_count"
    return rows.groupBy("county_fips", "date").agg(
        rsem.sum_skip("device_count").alias("device_count"),
        rsem.sum_skip(home).alias(home),
        rsem.mean_skip(1 - rsem.safe_div(home, "device_count")).alias("share_of_devices"),
        rsem.mean_skip(1 - rsem.safe_div(home, "candidate_device_count"))
        .alias("share_of_candidate_devices"),
        rsem.weighted_mean("device_count", "median_home_dwell_time", strict=True)
        .alias("median_home_dwell_time"),
        rsem.weighted_mean("device_count", "median_non_home_dwell_time", strict=True)
        .alias("median_non_home_dwell_time"))


def distancing_stream(spark: SparkSession, source_dir: str, bronze_dir: str, silver_dir: str,
                      checkpoint: str | None = None):
    """County-day device aggregates, updated per arriving daily file."""
    return _rollup_stream(spark, source_dir, schemas.DEVICE_DAILY, bronze_dir, silver_dir, "date",
                          _device_rows, _device_rollup, checkpoint)


# --- POI patterns: stateless place-week rows to county-week sums -------------------

def patterns_stream(spark: SparkSession, source_dir: str, poi_counties: DataFrame,
                    bronze_dir: str, silver_dir: str, checkpoint: str | None = None):
    """County-week POI visit sums, updated per arriving weekly file."""
    lookup = poi_counties.select("safegraph_place_id", "state", "county")

    def prepare(df: DataFrame) -> DataFrame:
        x = visitor_split(df.withColumn("date_week_start",
                                        cal.iso_prefix_date("date_range_start")))
        return x.select("safegraph_place_id", "date_week_start", "raw_visit_counts",
                        "raw_visitor_counts", "raw_visitor_counts_same_cbg",
                        "raw_visitor_counts_diff_cbg")

    def rollup(rows: DataFrame) -> DataFrame:
        return rows.join(lookup, "safegraph_place_id", "left").groupBy(
            "state", "county", "date_week_start").agg(
            rsem.sum_skip("raw_visit_counts").alias("total_visits"),
            rsem.sum_skip("raw_visitor_counts").alias("total_visitors"),
            rsem.sum_skip("raw_visitor_counts_same_cbg").alias("total_visitors_same_cbg"),
            rsem.sum_skip("raw_visitor_counts_diff_cbg").alias("total_visitors_diff_cbg"))

    return _rollup_stream(spark, source_dir, schemas.WEEKLY_PATTERNS, bronze_dir, silver_dir,
                          "date_week_start", prepare, rollup, checkpoint)
