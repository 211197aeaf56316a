"""NULL-semantics helpers (survey 1.4) on hand-computed micro fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from plume.functions import calendar as cal
from plume.functions import rsem
from plume.functions import strings as st


def test_strict_and_skipping_sum(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, None)], "g int, x double")
    out = {r.g: (r.strict, r.skip) for r in df.groupBy("g").agg(
        rsem.sum_strict("x").alias("strict"), rsem.sum_skip("x").alias("skip")).collect()}
    assert out == {1: (None, 1.0), 2: (None, 0.0)}


def test_strict_weighted_mean(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 6.0)], "n double, x double")
    assert df.agg(rsem.weighted_mean("n", "x").alias("m")).collect()[0].m == 5.0
    df2 = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "n double, x double")
    assert df2.agg(rsem.weighted_mean("n", "x").alias("m")).collect()[0].m is None
    # skipping form: missing products skipped, denominator keeps every n
    assert df2.agg(rsem.weighted_mean("n", "x", strict=False).alias("m")).collect()[0].m == 0.5


def test_mean_of_ratios_vs_ratio_of_sums(spark):
    df = spark.createDataFrame([(1.0, 2.0), (9.0, 10.0)], "a double, b double")
    r = df.agg(F.avg(rsem.safe_div("a", "b")).alias("mr"),
               rsem.safe_div(F.sum("a"), F.sum("b")).alias("rs")).collect()[0]
    assert abs(r.mr - 0.7) < 1e-12 and abs(r.rs - 10 / 12) < 1e-12


def test_ifelse_keeps_na_and_pmin(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (0, None)], "c int, v int")
    out = df.select(rsem.r_ifelse(F.col("c") == 1, 1, 0).alias("f"),
                    rsem.pmin("c", "v").alias("m")).collect()
    assert [(r.f, r.m) for r in out] == [(1, 1), (None, None), (0, None)]


def test_safe_div_and_clip(spark):
    df = spark.createDataFrame([(1.0, 0.0, -3.0), (4.0, 2.0, None)], "a double, b double, c double")
    out = df.select(rsem.safe_div("a", "b").alias("q"), rsem.clip_low0("c").alias("k")).collect()
    assert [(r.q, r.k) for r in out] == [(None, 0.0), (2.0, None)]


def test_zpad_never_truncates(spark):
    df = spark.createDataFrame([("1",), ("1001",), ("123456",)], "x string")
    assert [r.p for r in df.select(rsem.zpad("x", 5).alias("p")).collect()] == \
        ["00001", "01001", "123456"]


def test_null_key_join_matches_na(spark):
    left = spark.createDataFrame([(None, 1)], "k string, a int")
    right = spark.createDataFrame([(None, 9)], "k string, b int")
    out = rsem.left_join_na(left, right, ["k"]).collect()
    assert [(r.k, r.a, r.b) for r in out] == [(None, 1, 9)]


def test_week_label_and_lubridate_week(spark):
    days = [dt.date(2020, 1, 27), dt.date(2020, 2, 2), dt.date(2020, 2, 3), dt.date(2020, 5, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.w for r in df.select(cal.week_start("d").alias("w")).collect()]
    assert got == [dt.date(2020, 1, 27), dt.date(2020, 1, 27), dt.date(2020, 2, 3),
                   dt.date(2020, 5, 25)]
    df2 = spark.createDataFrame([(dt.date(2020, 1, 26),), (dt.date(2020, 1, 29),)], "d date")
    assert [r.w for r in df2.select(cal.r_week("d").alias("w")).collect()] == [4, 5]


def test_week_label_equals_reference_rule_on_study_range(spark):
    """T3 vs the reference's lead-2 lubridate-week rule over 2020-01-27..05-31."""
    spine = spark.sql("SELECT explode(sequence(DATE'2020-01-27', DATE'2020-05-31')) AS d")
    key = cal.shifted_week_key("d")
    from pyspark.sql import Window
    ref = F.min("d").over(Window.partitionBy(key))
    bad = spine.select((cal.week_start("d") != ref).alias("x")).filter("x").count()
    assert bad == 0


def test_parse_us_dates(spark):
    df = spark.createDataFrame([("3/5/2020",), ("03/25/2020",), ("junk",)], "s string")
    got = [r.d for r in df.select(cal.parse_date("s", cal.US_SLASH).alias("d")).collect()]
    assert got == [dt.date(2020, 3, 5), dt.date(2020, 3, 25), None]


def test_name_cleaning_and_separate(spark):
    df = spark.createDataFrame([("Autauga County, Alabama",)], "x string")
    out = st.separate(df, "x", ["county", "state"], sep=",", drop=False)
    r = out.select(st.clean_county("county").alias("c"), F.lower(F.trim("state")).alias("s")).collect()[0]
    assert (r.c, r.s) == ("autauga", "alabama")
    df2 = spark.createDataFrame([("a b c",), ("a",), ("",)], "x string")
    got = [(r.p1, r.p2) for r in st.separate(df2, "x", ["p1", "p2"]).collect()]
    assert got == [("a", "b"), ("a", None), ("", None)]


def test_str_sub_negative(spark):
    df = spark.createDataFrame([("010010201001",)], "x string")
    r = df.select(st.str_sub("x", 1, 5).alias("a"), st.str_sub("x", -3, -1).alias("b"),
                  st.str_sub("x", 2, -2).alias("c")).collect()[0]
    assert (r.a, r.b, r.c) == ("01001", "001", "1001020100")


def test_json_first_entry(spark):
    df = spark.createDataFrame([('{"010010201001": 7, "x": 2}',), ("{}",)], "j string")
    k, v = st.json_first_entry(F.col("j"))
    got = [(r.k, r.v) for r in df.select(k.alias("k"), v.alias("v")).collect()]
    assert got == [("010010201001", 7), (None, None)]
