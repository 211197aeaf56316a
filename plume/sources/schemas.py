"""Explicit schemas of the raw inputs and ordered column groups of the panel.

FIPS and block-group codes are text: inference would drop leading zeros.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, DT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.DateType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


POI_CORE = _st(("safegraph_place_id", S), ("naics_code", S), ("longitude", D), ("latitude", D))
COUNTY_POLYGONS = _st(("state", S), ("county", S), ("ring", I), ("seq", I), ("lon", D), ("lat", D))
WEEKLY_PATTERNS = _st(("safegraph_place_id", S), ("date_range_start", S), ("visits_by_day", S),
                      ("raw_visit_counts", L), ("raw_visitor_counts", L), ("poi_cbg", S),
                      ("visitor_home_cbgs", S))
COUNTY_FIPS = _st(("state", S), ("county", S), ("county_fips", S))
DEVICE_DAILY = _st(("origin_census_block_group", S), ("date_range_start", S), ("device_count", L),
                   ("completely_home_device_count", L), ("median_home_dwell_time", D),
                   ("median_non_home_dwell_time", D), ("candidate_device_count", L))
CASES_COUNTY = _st(("date", DT), ("county", S), ("state", S), ("fips", S), ("cases", L), ("deaths", L))
CASES_US = _st(("date", DT), ("cases", L), ("deaths", L))
COUNTY_AREA = _st(("Areaname", S), ("STCOU", S), ("LND110200D", D))
COUNTY_POPULATION = _st(("STATE", S), ("COUNTY", S), ("STNAME", S), ("CTYNAME", S),
                        ("POPESTIMATE2019", L))
COUNTY_POP_2016 = _st(("county", S), ("population", L))
ACS_LONG = _st(("GEOID", S), ("NAME", S), ("variable", S), ("estimate", D), ("moe", D))
STATE_ORDERS = _st(("state_code", S), ("state_name", S), ("sip_start_date", S), ("sip_end_date", S))
COUNTY_ORDERS = _st(("state_code", S), ("county_code", S), ("state", S), ("state_name", S),
                    ("county_name", S), ("popestimate2019", L),
                    ("state_sip_start_date", S), ("state_sip_end_date", S),
                    ("county_sip_start_date", S), ("county_sip_end_date", S),
                    ("citation1", S), ("citation2", S), ("citation3", S), ("citation4", S),
                    ("citation5", S))
WEATHER_DAILY = _st(("county", S), ("date", S), ("precip", D), ("tmin", D), ("tmax", D))
PRECINCT_VOTES = _st(("state", S), ("state_fips", S), ("state_postal", S), ("county_name", S),
                     ("county_fips", S), ("county_lat", D), ("county_long", D), ("office", S),
                     ("candidate", S), ("party", S), ("candidate_normalized", S), ("votes", L))
COUNTY_ATTRIBUTES = _st(("GEOID10", S), ("STATEFP10", S))

# --- ordered column groups of the weekly panel (survey 1.3) ----------------------
PANEL_IDS = ["state", "county", "county_fips", "week_start_date"]
POI_COLS = ["total_visits", "log_total_visits", "total_visitors", "log_total_visitors",
            "total_visitors_same_cbg", "share_visitors_same_cbg",
            "total_visitors_diff_cbg", "share_visitors_diff_cbg"]
DISTANCING_COLS = ["device_count", "completely_home_device_count", "devices_leaving_home",
                   "log_devices_leaving_home", "median_home_dwell_time",
                   "log_median_home_dwell_time", "median_non_home_dwell_time",
                   "log_median_non_home_dwell_time", "share_of_devices",
                   "share_of_candidate_devices", "share_adj_attrition"]
CENSUS_SHARES = ["share_asian", "share_black", "share_white", "share_bachelors",
                 "share_undergrad", "share_hhinc_100k", "share_poverty",
                 "share_msta", "share_services", "share_sales", "share_resources",
                 "share_public_transit"]
WEATHER_COLS = ["mean_precip", "mean_tmin", "mean_tmax"]
ORDER_COLS = ["sip_days", "weekly_sipo_binary"]
CASES_COLS = ["share_over_65", "log_pop_density", "log_cases", "log_deaths"]
VOTE_COLS = ["trump_vote_share", "county_republican", "republican_vtsh_ntile"]
