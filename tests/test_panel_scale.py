"""Steps of the panel builds that grow with the raw rows: each runs once, on all
tasks, and no raw device row is shuffled to its county."""

import datetime as dt

from pyspark.sql import functions as F

from plume.operators import intervals
from plume.plans import build, standins
from plume.sources import mobility


def _tables(spark, base):
    spark.createDataFrame([(0, "America")], "r_regionkey bigint, r_name string") \
        .write.parquet(f"{base}/region.parquet")
    spark.createDataFrame([(0, "Peru", 0)], "n_nationkey bigint, n_name string, n_regionkey bigint") \
        .write.parquet(f"{base}/nation.parquet")
    spark.createDataFrame([(k, 0, 10.0 * k, "BUILDING") for k in range(40)],
                          "c_custkey bigint, c_nationkey bigint, c_acctbal double, c_mktsegment string") \
        .coalesce(1).write.parquet(f"{base}/customer.parquet")
    spark.createDataFrame([(k, k % 40, "1-URGENT", 5.0, dt.date(1998, 2, 3)) for k in range(60)],
                          "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_totalprice double, o_orderdate date") \
        .write.parquet(f"{base}/orders.parquet")
    spark.createDataFrame([(k, 0.1, 0.2, 3.0, dt.date(1998, 2, 5)) for k in range(60)],
                          "l_orderkey bigint, l_discount double, l_tax double, l_quantity double, l_shipdate date") \
        .write.parquet(f"{base}/lineitem.parquet")


def test_device_rows_grow_on_all_tasks(spark, tmp_path):
    _tables(spark, tmp_path)
    devices = standins.nation_world(spark, str(tmp_path))["devices"]
    per_task = [r["count"] for r in devices.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 40 * 127
    assert len(per_task) >= 4        # one customer file, yet not one task


def test_weather_line_items_cross_one_shuffle_before_their_sums(spark, tmp_path):
    _tables(spark, tmp_path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weather = standins.nation_world(spark, str(tmp_path))["weather"]
        lines = weather._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and "l_orderkey" in x)
    path, depth = [], len(lines[at])
    for x in reversed(lines[:at + 1]):       # the scan's own ancestors
        here = len(x) - len(x.lstrip(" :+-"))
        if here < depth:
            path.append(x)
            depth = here
    assert sum("Exchange" in x for x in path) == 2      # to the orders, and the sums


def test_days_of_a_county_are_not_shuffled_to_its_base(spark):
    day0 = dt.date(2020, 1, 27)
    rows = [(f"01001{i:07d}", f"{day0 + dt.timedelta(days=k)}T00:00:00-05:00", 10 + i, 4, 1.0, 2.0, 20)
            for i in range(3) for k in range(2)]
    devices = spark.createDataFrame(
        rows, "origin_census_block_group string, date_range_start string, device_count bigint, "
              "completely_home_device_count bigint, median_home_dwell_time double, "
              "median_non_home_dwell_time double, candidate_device_count bigint")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily = mobility.distancing(devices, n_days=2)["daily"]
        plan = daily._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
        assert [r["device_count"] for r in daily.collect()] == [33, 33]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_panel_sources_run_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(r):
        seen.add(1)
        return r

    rows = [("01", "c", f"0100{k}", dt.date(2020, 1, 27), k / 10) for k in range(9)]
    merged = spark.createDataFrame(
        spark.sparkContext.parallelize(rows, 2).map(counted),
        "state string, county string, county_fips string, week_start_date date, trump_vote_share double")
    out = build._finish(merged, ["state", "county"], ["county_fips", "week_start_date"], [])
    got = sorted((r["county_fips"], r["republican_vtsh_ntile"]) for r in out.collect())
    assert got == [(f"0100{k}", k + 1) for k in range(9)]
    assert seen.value == 9


def test_overlapping_intervals_are_added_before_they_meet_the_points(spark):
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int") % 64)
    points = spark.range(64).select(day.alias("d"), F.lit("k").alias("k")) \
        .union(spark.sql("SELECT date'2020-01-05', CAST(NULL AS STRING)"))
    spans = spark.range(2000).select(
        F.when(F.col("id") % 9 > 0, "k").alias("k"), F.when(F.col("id") % 7 > 0, day).alias("a"),
        F.when(F.col("id") % 5 > 0, F.date_add(day, (F.col("id") % 23).cast("int"))).alias("b"),
        (F.col("id") % 4).alias("n"))
    pairs = intervals.range_join(points, spans, "d", "a", "b", ["k"])
    summed = intervals.range_join(points, spans, "d", "a", "b", ["k"], sums=["n"])
    total = lambda x: sorted(((r["k"] or "", r["d"], r["s"]) for r in
                              x.groupBy("k", "d").agg(F.sum("n").alias("s")).collect()))
    assert total(summed) == total(pairs)
    assert summed.count() <= 65 * 7 < pairs.count()
