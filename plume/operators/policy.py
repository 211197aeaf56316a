"""Policy-in-force flags over a date spine.

The reference encodes a missing start as +Inf and a missing end as 0 and then
compares; here the same three-case rule is written on nullable dates:

  in force on d  <=>  (start <= d and (end is null or end >= d))
                   or (start is null and end >= d)

so no sentinel ever enters a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.functions.calendar import week_start
from plume.functions.rsem import sum_skip


def in_force(d: Column, start: Column, end: Column) -> Column:
    """M5: 1 if the order is in force on date ``d``, else 0 (never null for a
    non-null date)."""
    started = start.isNotNull() & (start <= d) & (end.isNull() | (end >= d))
    end_only = start.isNull() & end.isNotNull() & (end >= d)
    return F.when(started | end_only, F.lit(1)).otherwise(F.lit(0))


def daily_flags(spine: DataFrame, date_col: str = "date",
                state=("state_sip_start_date", "state_sip_end_date"),
                local=("county_sip_start_date", "county_sip_end_date")) -> DataFrame:
    """M5 for both levels and their union (``sip_binary``)."""
    d = F.col(date_col)
    out = spine.withColumns({
        "state_sip": in_force(d, F.col(state[0]), F.col(state[1])),
        "county_sip": in_force(d, F.col(local[0]), F.col(local[1])),
    })
    return out.withColumn(
        "sip_binary",
        F.when((F.col("state_sip") == 1) | (F.col("county_sip") == 1), 1).otherwise(0))


def weekly_days(daily: DataFrame, keys: list[str], date_col: str = "date",
                flag: str = "sip_binary", carry: list[str] | None = None) -> DataFrame:
    """M6: days in force per (keys, Monday week) and the any-day flag."""
    carry = list(carry or [])
    out = daily.withColumn("week_start_date", week_start(date_col)) \
        .groupBy(*keys, "week_start_date", *carry) \
        .agg(sum_skip(flag).alias("sip_days"))
    return out.withColumn("weekly_sipo_binary",
                          F.when(F.col("sip_days") > 0, 1).otherwise(0))
