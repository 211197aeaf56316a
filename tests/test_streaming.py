"""Incremental roll-up equals the batch roll-up, across triggers and retries."""

import tempfile

from pyspark.sql import functions as F

from plume.sources import mobility
from plume.streaming import coverage, incremental

import world


def _norm(rows):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


def test_distancing_stream_matches_batch(spark):
    w = world.build(spark)
    base = tempfile.mkdtemp(prefix="plume-stream-")
    src, bronze, silver, ck = (f"{base}/{p}" for p in ("src", "bronze", "silver", "ck"))
    dev = w["device_daily"].withColumn("d", F.substring("date_range_start", 1, 10))
    first = dev.filter(F.col("d") < "2020-03-15").drop("d")
    second = dev.filter(F.col("d") >= "2020-03-15").drop("d")
    first.write.mode("append").option("header", True).csv(src)
    incremental.distancing_stream(spark, src, bronze, silver, ck).awaitTermination()
    second.write.mode("append").option("header", True).csv(src)
    incremental.distancing_stream(spark, src, bronze, silver, ck).awaitTermination()

    got = spark.read.parquet(silver)
    expect = incremental._device_rollup(incremental._device_rows(w["device_daily"]))
    cols = ["county_fips", "date", "device_count", "completely_home_device_count",
            "share_of_devices", "median_home_dwell_time"]
    assert _norm(got.select(*cols).collect()) == _norm(expect.select(*cols).collect())
    # a third trigger with no new files changes nothing
    incremental.distancing_stream(spark, src, bronze, silver, ck).awaitTermination()
    assert spark.read.parquet(silver).count() == expect.count()


def test_patterns_stream_matches_batch(spark):
    w = world.build(spark)
    base = tempfile.mkdtemp(prefix="plume-stream-")
    src, bronze, silver, ck = (f"{base}/{p}" for p in ("src", "bronze", "silver", "ck"))
    poi = mobility.poi_counties(w["poi_core"], w["county_polygons"], cell=0.5)
    w["weekly_patterns"].write.mode("append").option("header", True).csv(src)
    incremental.patterns_stream(spark, src, poi, bronze, silver, ck).awaitTermination()
    got = spark.read.parquet(silver).select("state", "county", "date_week_start", "total_visits",
                                            "total_visitors_same_cbg")
    batch = mobility.poi_patterns(w["weekly_patterns"], poi)["weekly"].select(
        "state", "county", "date_week_start", "total_visits", "total_visitors_same_cbg")
    assert _norm(got.collect()) == _norm(batch.collect())


def _coverage_of(rows):
    """County -> (days seen, mean device count of the base week) by plain Python."""
    out = {}
    for r in rows:
        county, day = str(r["origin_census_block_group"]).rjust(12, "0")[:5], r["date_range_start"][:10]
        days, counts = out.setdefault(county, (set(), []))
        days.add(day)
        if "2020-01-27" <= day <= "2020-02-02" and r["device_count"] is not None:
            counts.append(r["device_count"])
    return {c: (len(days), sum(n) / len(n) if n else None) for c, (days, n) in out.items()}


def test_coverage_state_ends_at_the_batch_answer_in_any_order(spark):
    rows = world.build(spark)["device_daily"]
    want = _coverage_of(rows.collect())
    month = F.substring("date_range_start", 6, 2)
    for turn, order in enumerate((["05", "02", "01", "04", "03", "06"], ["01", "02", "03", "04", "05", "06"])):
        base = tempfile.mkdtemp(prefix="plume-cover-")
        src, out, ck = (f"{base}/{p}" for p in ("src", "out", "ck"))
        for k, m in enumerate(order):
            rows.filter(month == m).coalesce(2).write.mode("append").option("header", True).csv(src)
            if turn == 0 and k in (0, 3, 5) or k == 5:  # restarts go on from the state
                coverage.coverage_stream(spark, src, out, checkpoint=ck, max_files=3).awaitTermination()
        got = {r["county_fips"]: (r["n_days"], r["initial_device_count"])
               for r in coverage.read_coverage(spark, out).collect()}
        assert got == want
    most = max(n for n, _ in want.values())
    assert {r["county_fips"] for r in coverage.read_coverage(spark, out, most).collect()} == {
        c for c, (n, _) in want.items() if n == most}
    # nothing new: nothing changes
    coverage.coverage_stream(spark, src, out, checkpoint=ck).awaitTermination()
    assert coverage.read_coverage(spark, out).count() == len(want)
