"""Day coverage (M8) and the attrition base (M1) as stream state (survey 2.14).

Both need a county's whole date range, so a micro-batch alone cannot give them.
Here a county's state is the set of days seen and the sum and number of device
counts in the base week; every batch adds to it, whatever order the files arrive
in, and the answer after the last file is the batch answer.

A task first adds up its rows by (county, day), so a county with a third of a
batch's rows sends a few rows a task to its state.  A county's state is at most a
number per day of the study.  Updated counties are written under
``batch_id=<id>`` with overwrite, so a repeated batch is idempotent; a county's
current answer is its row of the highest batch.

Edge cases: rows without a readable county or date are left out; a missing
device count marks the day as seen and takes no part in the mean; rows that
arrive twice in different files count twice in the mean, as they do in the batch
build; a county without base-week rows has a null mean.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from plume.session import scratch_path
from plume.sources import schemas
from plume.sources.mobility import BASE_END, BASE_START
from plume.streaming.incremental import _device_rows

_DAILY = "county_fips string, day int, base_sum bigint, base_n bigint"
_ANSWER = "county_fips string, n_days bigint, base_sum bigint, base_n bigint"
#: the days as text, because state fields are plain values
_STATE = "days string, base_sum bigint, base_n bigint"


def _day_number(text: str) -> int:
    return (dt.date.fromisoformat(text) - dt.date(1970, 1, 1)).days


def _by_day(first: int, last: int):
    """Adds up a task's rows by county and day."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            inside = b["day"].between(first, last) & b["device_count"].notna()
            got = pd.DataFrame({"county_fips": b["county_fips"], "day": b["day"],
                                "base_sum": b["device_count"].where(inside, 0).fillna(0).astype("int64"),
                                "base_n": inside.astype("int64")})
            yield got.groupby(["county_fips", "day"], as_index=False).sum()
    return work


def _add(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A county's state and new rows -> its state, and its answer so far."""
    text, total, n = state.get if state.exists else ("", 0, 0)
    days = set(map(int, text.split(","))) if text else set()
    for p in parts:
        days.update(int(d) for d in p["day"])
        total, n = total + int(p["base_sum"].sum()), n + int(p["base_n"].sum())
    state.update((",".join(map(str, sorted(days))), total, n))
    yield pd.DataFrame({"county_fips": [key[0]], "n_days": [len(days)], "base_sum": [total], "base_n": [n]})


def coverage_stream(spark: SparkSession, source_dir: str, out_dir: str, base: tuple[str, str] = (BASE_START, BASE_END),
                    checkpoint: str | None = None, max_files: int = 32):
    """Start the stream over the device files of a folder; it ends when all
    present files are read and goes on from its checkpoint when started again."""
    stream = (spark.readStream.schema(schemas.DEVICE_DAILY).option("header", True)
              .option("maxFilesPerTrigger", max_files).csv(source_dir))
    rows = _device_rows(stream).select("county_fips", F.unix_date("date").alias("day"),
                                       F.col("device_count").cast("bigint").alias("device_count")) \
        .filter("county_fips is not null and day is not null")
    daily = rows.mapInPandas(_by_day(*map(_day_number, base)), _DAILY)
    updates = daily.groupBy("county_fips").applyInPandasWithState(
        _add, _ANSWER, _STATE, "update", GroupStateTimeout.NoTimeout)

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    ckpt = checkpoint or scratch_path(spark, "streams", out_dir.strip("/").replace("/", "_"))
    return (updates.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def read_coverage(spark: SparkSession, out_dir: str, n_days: int | None = None) -> DataFrame:
    """(county_fips, n_days, initial_device_count) after the batches so far;
    with ``n_days`` the counties seen on that many days."""
    rows = spark.read.parquet(out_dir).groupBy("county_fips").agg(
        F.max_by(F.struct("n_days", "base_sum", "base_n"), "batch_id").alias("a"))
    out = rows.select("county_fips", F.col("a.n_days").alias("n_days"),
                      F.try_divide(F.col("a.base_sum"), F.col("a.base_n")).alias("initial_device_count"))
    return out if n_days is None else out.filter(F.col("n_days") == n_days)
