"""The reference's pipelines (D1-D17) end to end on the fixture world."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plume.plans import build, report
from plume.sources import context, health, mobility, schemas

import world


@pytest.fixture(scope="module")
def w(spark):
    return world.build(spark)


@pytest.fixture(scope="module")
def stages(spark, w):
    poi = mobility.poi_counties(w["poi_core"], w["county_polygons"], cell=0.5)
    pats = mobility.poi_patterns(w["weekly_patterns"], poi)
    out = {
        "poi": poi,
        "patterns": pats,
        "poi_weekly": mobility.poi_weekly_outcomes(pats["weekly"], w["county_fips"]),
        "dist": mobility.distancing(w["device_daily"]),
        "cases": health.cases(spark, w["cases_county"], w["county_orders"], w["county_population"],
                              w["county_area"], w["acs_long"]),
        "orders": health.orders(w["county_orders"], w["county_population"]),
        "weather": context.weather(w["weather_daily"]),
        "census": context.census(w["acs_long"], w["county_pop_2016"]),
        "votes": context.votes(w["precinct_votes"]),
    }
    return out


def test_d1_poi_lookup(stages):
    rows = {r.safegraph_place_id: (r.state, r.county) for r in stages["poi"].collect()}
    assert rows["sg-01001-0"] == ("alabama", "autauga")
    assert rows["sg-nowhere"] == (None, None)
    share = mobility.null_county_share(stages["poi"]).collect()[0]
    assert abs(share.null_county_share - 1 / 13) < 1e-12


def test_d2_two_grains_agree_and_split_adds_up(stages):
    p = stages["patterns"]
    a = p["weekly"].agg(F.sum("total_visits"), F.sum("total_visitors")).collect()[0]
    b = p["weekly_naics"].agg(F.sum("total_visits"), F.sum("total_visitors")).collect()[0]
    assert tuple(a) == tuple(b)
    bad = p["weekly"].filter(F.col("total_visitors_same_cbg") + F.col("total_visitors_diff_cbg")
                             != F.col("total_visitors")).count()
    assert bad == 0
    d = p["daily"].agg(F.sum("total_visits")).collect()[0][0]
    assert d == a[0]
    assert p["daily"].select("date").distinct().count() == 18 * 7


def test_d2_visitor_split_fixtures(spark):
    rows = [("a", 5, "010010201001", '{"010010201001": 7}'), ("b", 5, "010010201001", "{}"),
            ("c", 5, None, '{"060": 2}'), ("d", 5, "10010201001", '{"010010201001": 2, "x": 1}')]
    df = spark.createDataFrame(rows, "id string, raw_visitor_counts long, poi_cbg string, "
                                     "visitor_home_cbgs string")
    got = {r.id: (r.raw_visitor_counts_same_cbg, r.raw_visitor_counts_diff_cbg)
           for r in mobility.visitor_split(df).collect()}
    assert got == {"a": (5, 0), "b": (0, 5), "c": (None, None), "d": (2, 3)}
    look = {r.id: r.raw_visitor_counts_same_cbg
            for r in mobility.visitor_split(df, mode="lookup").collect()}
    assert look == {"a": 5, "b": 0, "c": None, "d": 2}


def test_d3_outcomes(stages):
    x = stages["poi_weekly"]
    assert x.columns[:4] == ["state", "county", "county_fips", "week_start_date"]
    assert x.filter(F.col("county_fips").isNull() & F.col("county").isNotNull()).count() == 0


def test_d4_distancing(stages):
    daily, weekly = stages["dist"]["daily"], stages["dist"]["weekly"]
    kept = {r.county_fips for r in daily.select("county_fips").distinct().collect()}
    assert kept == {"01001", "36061", "36047", "17031"}   # no Alaska, no partial coverage
    assert daily.groupBy("county_fips").count().agg(F.min("count")).collect()[0][0] == 128
    weeks = sorted(r.week_start_date for r in weekly.select("week_start_date").distinct().collect())
    assert weeks[0] == dt.date(2020, 1, 27) and weeks[-1] == dt.date(2020, 5, 25)
    assert weekly.columns == ["county_fips", "week_start_date", *schemas.DISTANCING_COLS]


def test_d4_attrition_fixture(spark):
    rows = [("010010201001", "2020-01-27T00:00", 100, 40, 1.0, 1.0, 100),
            ("010010201002", "2020-01-27T00:00", 100, 40, 1.0, 1.0, 100),
            ("010010201001", "2020-03-02T00:00", 90, 30, 1.0, 1.0, 90),
            ("010010201002", "2020-03-02T00:00", 150, 20, 1.0, 1.0, 150)]
    df = spark.createDataFrame(rows, schemas.DEVICE_DAILY)
    out = mobility.distancing(df, n_days=2)["daily"]
    r = out.filter(F.col("date") == dt.date(2020, 3, 2)).collect()[0]
    assert abs(r.share_adj_attrition - 0.8) < 1e-12


def test_d5_cases(stages):
    daily = stages["cases"]["daily"]
    nyc = daily.filter(F.col("county_fips") == "36061").select("popestimate2019").distinct().collect()
    assert [r[0] for r in nyc] == [world.POP["36061"] + world.POP["36047"]]
    assert daily.filter(F.col("county_fips") == "36047").count() == 0
    assert daily.groupBy("county_fips").count().agg(F.max("count")).collect()[0][0] == 126
    nyc_cases = daily.filter((F.col("county_fips") == "36061") &
                             (F.col("date") == dt.date(2020, 5, 31))).collect()[0]
    assert nyc_cases.cases > 0 and nyc_cases.log_pop_density is not None
    wk = stages["cases"]["weekly"]
    assert wk.filter(F.col("log_cases").isNull()).count() == 0


def test_d6_orders(stages):
    d = stages["orders"]["daily"]
    flag = {r.date: r.sip_binary for r in
            d.filter(F.col("county_fips") == "01003").collect()}
    assert flag[dt.date(2020, 3, 19)] == 0 and flag[dt.date(2020, 3, 20)] == 1
    il = {r.date: (r.state_sip, r.county_sip) for r in d.filter(F.col("county_fips") == "17031").collect()}
    assert il[dt.date(2020, 4, 30)] == (1, 1) and il[dt.date(2020, 5, 1)] == (1, 0)
    assert il[dt.date(2020, 5, 30)] == (0, 0)
    ak = d.filter(F.col("county_fips") == "02013").agg(F.max("sip_binary")).collect()[0][0]
    assert ak == 0
    wk = stages["orders"]["weekly"]
    assert wk.filter(F.col("sip_days") > 7).count() == 0
    assert d.select("county", "state").filter(F.col("county_fips") == "01001").first() == ("autauga", "alabama")
    sc = health.state_order_dates(d, "alabama")
    assert sc.count() == 2


def test_d7_weather(stages):
    wk = stages["weather"]["weekly"]
    assert wk.groupBy("county_fips", "week_start_date").count().filter("count > 1").count() == 0
    assert wk.agg(F.min("week_start_date")).collect()[0][0] == dt.date(2020, 1, 27)


def test_d8_census(stages):
    c = stages["census"]
    assert c.columns == ["county_fips", "county", "state", *schemas.CENSUS_SHARES]
    r = c.filter(F.col("county_fips") == "01001").collect()[0]
    assert (r.county, r.state) == ("autauga", "alabama") and abs(r.share_asian - 0.05) < 1e-12
    assert abs(r.share_msta - 0.2) < 1e-12


def test_d9_votes(stages):
    v = {r.county_fips: r.trump_vote_share for r in stages["votes"].collect()}
    assert abs(v["01001"] - (100 + 101) / (100 + 101 + 600)) < 1e-12


def test_d9_fan_out_is_caught(spark, w):
    from plume.operators.joins import FanOutError
    bad = w["precinct_votes"].unionByName(w["precinct_votes"].filter(
        F.col("candidate_normalized") == "trump").withColumn("county_lat", F.lit(31.0)))
    with pytest.raises(FanOutError):
        context.votes(bad, check_unique=True).count()


def test_d10_to_d13_panels(spark, w, stages):
    panel = build.panel_weekly(stages["poi_weekly"], stages["dist"]["weekly"], stages["census"],
                               stages["weather"]["weekly"], stages["orders"]["weekly"],
                               stages["cases"]["weekly"], stages["votes"], check_unique=True)
    cols = panel.columns
    assert len(cols) == 47 and cols[:4] == schemas.PANEL_IDS
    assert cols[-3:] == ["trump_vote_share", "county_republican", "republican_vtsh_ntile"]
    assert panel.count() == stages["poi_weekly"].filter(
        F.col("county_fips").isin("01001", "01003", "36061", "36047", "02013", "17031")).count()
    dpanel = build.panel_distancing_weekly(stages["dist"]["weekly"], stages["census"],
                                           stages["weather"]["weekly"], stages["orders"]["weekly"],
                                           stages["cases"]["weekly"], stages["votes"])
    assert len(dpanel.columns) == 39   # survey 1.3: the 47 minus the 8 POI columns
    daily = build.panel_daily(stages["dist"]["daily"], stages["census"], stages["weather"]["daily"],
                              stages["orders"]["daily"], stages["cases"]["daily"], stages["votes"])
    assert daily["one_state"].select("state").distinct().collect()[0][0] == "illinois"
    attrs = build.votes_with_attributes(stages["votes"], w["county_attributes"])
    assert attrs.count() == 5
    prof = build.coverage_report(panel.select("total_visits", "share_asian", "log_cases"))
    assert prof.count() == 3


def test_d14_to_d16_reports(spark, stages):
    panel = build.panel_weekly(stages["poi_weekly"], stages["dist"]["weekly"], stages["census"],
                               stages["weather"]["weekly"], stages["orders"]["weekly"],
                               stages["cases"]["weekly"], stages["votes"])
    est = report.event_study(spark, panel)
    assert est.select("model").distinct().count() == 6
    assert est.filter(F.col("term") == "trump_vote_share").count() == 0   # swept out (E11)
    tr = report.partisan_trends(panel)
    base = tr.filter(F.col("week_start_date") == dt.date(2020, 1, 27)).collect()
    assert all(abs(r.total_visits_adj - 1.0) < 1e-12 for r in base)
    assert report.partisan_cases_long(panel).select("measure").distinct().count() == 2
    dec = report.map_deciles(panel)
    assert dec.filter(F.col("decile").isNotNull()).count() > 0
    one_map = report.map_week(dec, "weeks_since_start", 0)
    assert one_map.columns == ["region", "value"] and one_map.count() > 0
