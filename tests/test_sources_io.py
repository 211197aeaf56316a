"""Scans, sinks and remaining quirks."""

import datetime as dt
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from plume.functions import calendar as cal
from plume.operators import shape
from plume.sources import context, health, io, schemas
from plume.stats import regress


def test_typed_csv_keeps_leading_zeros_and_trims(spark):
    d = tempfile.mkdtemp(prefix="plume-io-")
    os.makedirs(f"{d}/a/b")
    with open(f"{d}/a/processed_weekly_2020_01.csv", "w") as f:
        f.write("state,county,county_fips\nalabama, autauga ,01001\n")
    with open(f"{d}/a/b/processed_weekly_2020_02.csv", "w") as f:
        f.write("state,county,county_fips\nalabama,baldwin,01003\n")
    with open(f"{d}/a/other.csv", "w") as f:
        f.write("state,county,county_fips\nx,y,99999\n")
    df = io.read_csv(spark, f"{d}/a", schemas.COUNTY_FIPS, recursive=True,
                     glob="processed_weekly_2020*")
    assert sorted(tuple(r) for r in df.collect()) == [("alabama", "autauga", "01001"),
                                                     ("alabama", "baldwin", "01003")]


def test_snapshot_sink_and_partition_read(spark):
    base = tempfile.mkdtemp(prefix="plume-snap-")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    io.write_snapshot(df, base, "2020-06-04")
    io.write_snapshot(df.withColumn("v", F.lit("b")), base, "2020-06-05")
    assert io.read_latest(spark, base).collect()[0].v == "b"
    assert io.read_snapshot(spark, base, "2020-06-04").collect()[0].v == "a"
    assert spark.range(1).select(cal.as_of_label("2020-06-04").alias("l")).collect()[0].l == "06-04"


def test_multi_output_and_parquet_roundtrip(spark):
    base = tempfile.mkdtemp(prefix="plume-multi-")
    a = spark.createDataFrame([(1, dt.date(2020, 1, 27))], "k int, week_start_date date")
    io.multi_output({"weekly": a, "weekly_naics": a}, base, {"weekly": ["week_start_date"]})
    assert spark.read.parquet(f"{base}/weekly").count() == 1
    assert spark.read.parquet(f"{base}/weekly_naics").count() == 1


def test_append_and_replace_rows(spark):
    df = spark.createDataFrame([("36", "061", 1), ("36", "047", 2), ("01", "001", 3)],
                               "s string, c string, pop long")
    patch = spark.createDataFrame([("36", "061", 3)], "s string, c string, pop long")
    out = shape.replace_rows(df.filter(F.col("c") != "047"), patch, ["s", "c"])
    assert sorted(tuple(r) for r in out.collect()) == [("01", "001", 3), ("36", "061", 3)]
    out2 = shape.append_rows(df, spark.createDataFrame([("99", "999")], "s string, c string"))
    assert out2.filter(F.col("s") == "99").collect()[0].pop is None


def test_borough_fips_compat(spark):
    area = spark.createDataFrame(
        [("New York, NY", "36061", 10.0), ("Richmond, NY", "36085", 20.0),
         ("Kings, NY", "36047", 30.0)], schemas.COUNTY_AREA)
    fixed = {r.county_fips: r.km_sq for r in health.county_area(spark, area).collect()}
    compat = {r.county_fips: r.km_sq for r in health.county_area(spark, area, compat=True).collect()}
    assert abs(fixed["36061"] - 60 * health.SQ_MI_TO_KM) < 1e-9
    # the compat list misses Richmond (36085), which then stays its own county
    assert abs(compat["36061"] - 40 * health.SQ_MI_TO_KM) < 1e-9 and "36085" in compat


def test_weather_days_fall_in_their_true_week(spark):
    rows = [("1001", "2020-02-01", 1.0, 1.0, 1.0), ("1001", "2020-02-02", 2.0, 2.0, 2.0),
            ("1003", "2020-01-27", 3.0, 3.0, 3.0)]
    wk = context.weather(spark.createDataFrame(rows, schemas.WEATHER_DAILY))["weekly"]
    got = {(r.county_fips, r.week_start_date): r.mean_precip for r in wk.collect()}
    assert got == {("01001", dt.date(2020, 1, 27)): 1.5, ("01003", dt.date(2020, 1, 27)): 3.0}


def test_two_way_unbalanced_matches_dummy_ols(spark):
    rng = np.random.default_rng(7)
    rows = []
    for e in range(12):
        for t in range(6):
            if (e + t) % 5 == 0:
                continue   # unbalanced
            x = rng.normal()
            rows.append((e, t, x, 0.7 * x + e * 0.3 + t * 0.5 + rng.normal() * 0.1))
    df = spark.createDataFrame(rows, "e long, t long, x double, y double")
    fit = regress.two_way_within(df, "y", ["x"], "e", "t")
    d = df.select("*", *[(F.col("e") == i).cast("double").alias(f"e{i}") for i in range(12)],
                  *[(F.col("t") == j).cast("double").alias(f"t{j}") for j in range(1, 6)])
    full = regress.ols(d, "y", ["x", *[f"e{i}" for i in range(12)], *[f"t{j}" for j in range(1, 6)]],
                       intercept=False)
    assert abs(fit.coef[0] - full.coef[0]) < 1e-8


def test_gzip_csv_roundtrip_sorted_sink(spark):
    base = tempfile.mkdtemp(prefix="plume-gz-")
    df = spark.createDataFrame([("a", "b", "01003"), (None, "c", "00001"), ("a", "a", "01001")],
                               schemas.COUNTY_FIPS)
    io.to_csv(df, f"{base}/out", order_by=["state", "county"], compression="gzip")
    assert any(f.endswith(".gz") for f in os.listdir(f"{base}/out"))
    back = io.read_csv(spark, f"{base}/out", schemas.COUNTY_FIPS)
    assert back.count() == 3 and back.filter(F.col("county_fips") == "00001").count() == 1
    assert [r.county for r in shape.arrange(back, "state", "county").collect()] == ["a", "b", "c"]


def test_preview_pages_columns(spark):
    df = spark.range(50).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(20)])
    p = shape.preview(df, 14, 20)
    assert p.columns == [f"c{i}" for i in range(13, 20)] and p.count() == 10


def test_join_back_total_and_tables(spark):
    from plume.operators import joins
    lit = io.literal_table(spark, [("a", 1.0), ("a", 3.0), ("b", 2.0)], "g string, x double")
    out = {(r.g, r.x): r.tot for r in joins.join_back_total(lit, ["g"], "x", "tot").collect()}
    assert out == {("a", 1.0): 4.0, ("a", 3.0): 4.0, ("b", 2.0): 2.0}
    base = tempfile.mkdtemp(prefix="plume-tbl-")
    io.to_parquet(lit, f"{base}/t")
    assert io.read_table(spark, f"{base}/t").count() == 3
    io.to_csv(lit, f"{base}/c")
    assert io.read_table(spark, f"{base}/c", fmt="csv", schema="g string, x double").count() == 3
