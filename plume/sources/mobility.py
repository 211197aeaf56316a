"""Mobility sources: POI -> county lookup (D1), POI visit patterns (D2, D3) and
device distancing (D4).

Partitioning: POI rows are keyed by place id, device rows by block group.
Every aggregation here is a map-side-combined ``groupBy`` on the county (and
period) key, so the raw rows are shuffled only once, already reduced; no
window runs over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.functions import calendar as cal
from plume.functions import rsem
from plume.functions import strings as st
from plume.operators import joins, shape, spatial
from plume.session import ensure_checkpoint_dir

# Fixed values of the distancing build (must equal the reference's)
DISTANCING_DAYS = 128            # full coverage: days per kept county
BASE_START, BASE_END = "2020-01-27", "2020-02-02"   # initial device count window
LAST_DAY = "2020-05-31"          # weekly series end
FIRST_WEEK = "2020-01-27"        # first kept Monday week
DROP_STATE = "02"                # Alaska

COUNTIES_SENT = 100_000          # covered counties broadcast at most (about 3,100 in the reference)


# --- D1 ------------------------------------------------------------------------

def poi_counties(core: DataFrame, polygons: DataFrame, cell: float = 0.25) -> DataFrame:
    """safegraph_place_id, naics_code, longitude, latitude, state, county."""
    pts = core.select("safegraph_place_id", "naics_code", "longitude", "latitude")
    out = spatial.points_to_polygons(pts, polygons, "longitude", "latitude",
                                     ["safegraph_place_id"], cell)
    return out.select("safegraph_place_id", "naics_code", "longitude", "latitude",
                      "state", "county")


def null_county_share(poi: DataFrame) -> DataFrame:
    """The reference's sanity metric (about 4.37% of POIs fall in no county)."""
    return poi.agg(rsem.null_share("county").alias("null_county_share"),
                   F.count(F.lit(1)).alias("n_poi"))


# --- D2 ------------------------------------------------------------------------

def visitor_split(patterns: DataFrame, mode: str = "first") -> DataFrame:
    """M4: visitors from the POI's own block group and from elsewhere.

    ``mode="first"`` keeps the reference's assumption (K4) that the first
    entry of the home map is the POI's own block group when present;
    ``mode="lookup"`` reads the POI's key from the map instead.  Both sides
    are padded to 12 digits (K5).
    """
    poi = rsem.zpad("poi_cbg", 12)
    total = F.col("raw_visitor_counts")
    if mode == "first":
        k, v = st.json_first_entry(F.col("visitor_home_cbgs"))
        # an empty map still yields an (empty) first key, as the text split does
        key = F.when(F.col("visitor_home_cbgs").isNotNull(), F.coalesce(k, F.lit("")))
        count = F.coalesce(v.cast("long"), F.lit(0).cast("long"))
        same = rsem.r_ifelse(key == poi, count, F.lit(0).cast("long"))
    elif mode == "lookup":
        found = st.json_lookup(F.col("visitor_home_cbgs"), poi).cast("long")
        same = F.when(poi.isNotNull(), F.coalesce(found, F.lit(0).cast("long")))
    else:
        raise ValueError(mode)
    same = rsem.pmin(total, same)
    return patterns.withColumns({
        "raw_visitor_counts_same_cbg": same,
        "raw_visitor_counts_diff_cbg": total - same,
    })


_WEEKLY_SUMS = {
    "total_visits": "raw_visit_counts",
    "total_visitors": "raw_visitor_counts",
    "total_visitors_same_cbg": "raw_visitor_counts_same_cbg",
    "total_visitors_diff_cbg": "raw_visitor_counts_diff_cbg",
}


def poi_patterns(patterns: DataFrame, poi: DataFrame, mode: str = "first") -> dict[str, DataFrame]:
    """Weekly and daily visits at county and county-NAICS grain.

    The NAICS grain is aggregated from the rows once; the county grain is
    rolled up from it (sums are additive).  Rows meet the lookup before their
    seven days are exploded, so weekly and daily outputs share one join of the
    raw rows and the exploded days go straight into partial sums.
    """
    lookup = poi.select("safegraph_place_id", "naics_code", "state", "county")
    w = patterns.withColumn("date_week_start", cal.iso_prefix_date("date_range_start"))
    w = visitor_split(w, mode).join(lookup, "safegraph_place_id", "left") \
        .withColumn("naics", F.substring("naics_code", 1, 2))
    weekly_naics = w.groupBy("state", "county", "naics", "date_week_start").agg(
        *[rsem.sum_skip(src).alias(dst) for dst, src in _WEEKLY_SUMS.items()])
    weekly = weekly_naics.groupBy("state", "county", "date_week_start").agg(
        *[F.sum(c).alias(c) for c in _WEEKLY_SUMS])

    d = shape.explode_daily_array(
        w.select("state", "county", "naics", "visits_by_day", "date_week_start"),
        "visits_by_day", "date_week_start", "date", "visits")
    daily_naics = d.groupBy("state", "county", "naics", "date").agg(
        rsem.sum_skip("visits").alias("total_visits"))
    daily = daily_naics.groupBy("state", "county", "date").agg(
        F.sum("total_visits").alias("total_visits"))
    return {"weekly": weekly, "weekly_naics": weekly_naics,
            "daily": daily, "daily_naics": daily_naics}


def poi_patterns_stacked(patterns: DataFrame, poi: DataFrame, mode: str = "first") -> DataFrame:
    """The four outputs of ``poi_patterns`` from one scan of the raw rows.

    Each row becomes its weekly entry and its seven daily ones; grouping sets
    then add up both grains (county, county and NAICS) of both kinds in one
    aggregate, combined map-side.  ``output`` names the result a row belongs to
    (weekly, weekly_naics, daily, daily_naics); visitors are weekly only.
    """
    lookup = poi.select("safegraph_place_id", "naics_code", "state", "county")
    w = patterns.withColumn("start", cal.iso_prefix_date("date_range_start"))
    w = visitor_split(w, mode).join(lookup, "safegraph_place_id", "left") \
        .withColumn("naics", F.substring("naics_code", 1, 2))

    def entry(kind: str, date, *counts):
        return F.struct(F.lit(kind).alias("kind"), date.alias("date"), *[
            (c.cast("bigint") if c is not None else F.lit(None).cast("bigint")).alias(name)
            for c, name in zip(counts, _WEEKLY_SUMS)])

    week = entry("weekly", F.col("start"), *[F.col(c) for c in _WEEKLY_SUMS.values()])
    days = F.transform(
        F.coalesce(F.from_json("visits_by_day", "array<int>"), F.array().cast("array<int>")),
        lambda v, i: entry("daily", F.date_add(F.col("start"), i), v, None, None, None))
    x = w.select("state", "county", "naics", F.inline(F.concat(F.array(week), days)))
    keys = ["kind", "state", "county", "date"]
    g = x.groupingSets([keys, [*keys, "naics"]], *keys, "naics").agg(
        F.grouping("naics").alias("rolled"), *[rsem.sum_skip(c).alias(c) for c in _WEEKLY_SUMS])
    output = F.concat("kind", F.when(F.col("rolled") == 1, "").otherwise("_naics"))
    return g.select(output.alias("output"), "state", "county", "naics", "date", "total_visits", *[
        F.when(F.col("kind") == "weekly", F.col(c)).alias(c) for c in list(_WEEKLY_SUMS)[1:]])


# --- D3 ------------------------------------------------------------------------

def poi_weekly_outcomes(weekly: DataFrame, county_fips: DataFrame) -> DataFrame:
    """Weekly POI outcomes with logs and shares, FIPS joined on names (K8)."""
    x = weekly.withColumns({
        "log_total_visits": rsem.log1p("total_visits"),
        "log_total_visitors": rsem.log1p("total_visitors"),
        "share_visitors_same_cbg": rsem.safe_div("total_visitors_same_cbg", "total_visitors"),
        "share_visitors_diff_cbg": rsem.safe_div("total_visitors_diff_cbg", "total_visitors"),
    }).withColumnRenamed("date_week_start", "week_start_date")
    x = x.select("state", "county", "week_start_date",
                 "total_visits", "log_total_visits", "total_visitors", "log_total_visitors",
                 "total_visitors_same_cbg", "share_visitors_same_cbg",
                 "total_visitors_diff_cbg", "share_visitors_diff_cbg")
    x = joins.left_join(x, county_fips, ["state", "county"], null_keys=True)
    return shape.front(x, "state", "county", "county_fips")


# --- D4 ------------------------------------------------------------------------

def _distancing_rows(devices: DataFrame) -> DataFrame:
    bg = rsem.zpad("origin_census_block_group", 12)
    return devices.select(
        F.substring(bg, 1, 5).alias("county_fips"),
        cal.iso_prefix_date("date_range_start").alias("date"),
        "device_count", "completely_home_device_count", "median_home_dwell_time",
        "median_non_home_dwell_time", "candidate_device_count")


def _finish(df: DataFrame, t: str) -> DataFrame:
    x = df.withColumns({
        "devices_leaving_home": F.col("device_count") - F.col("completely_home_device_count")})
    x = x.withColumns({
        "log_devices_leaving_home": rsem.log1p("devices_leaving_home"),
        "log_median_home_dwell_time": rsem.log1p("median_home_dwell_time"),
        "log_median_non_home_dwell_time": rsem.log1p("median_non_home_dwell_time")})
    return x.select("county_fips", t, "device_count", "completely_home_device_count",
                    "devices_leaving_home", "log_devices_leaving_home",
                    "median_home_dwell_time", "log_median_home_dwell_time",
                    "median_non_home_dwell_time", "log_median_non_home_dwell_time",
                    "share_of_devices", "share_of_candidate_devices", "share_adj_attrition")


def distancing(devices: DataFrame, n_days: int = DISTANCING_DAYS, base=(BASE_START, BASE_END),
               last_day: str = LAST_DAY, first_week: str = FIRST_WEEK,
               drop_state: str = DROP_STATE) -> dict[str, DataFrame]:
    """Block-group days -> county-day and county-week distancing measures.

    Steps: coverage filter (M8), Alaska drop, row shares (M3), attrition-
    adjusted share (M1), county-day roll-up with the strict weighted dwell
    times (A10, K11), then the county-week roll-up with skipping weights.
    """
    rows = _distancing_rows(devices)
    rows = rows.filter(F.substring("county_fips", 1, 2) != drop_state)
    # pass 1 (county grain): day coverage (M8) and the base-week mean device
    # count (M1) in one aggregate; only covered counties are kept
    in_base = F.col("date").between(F.to_date(F.lit(base[0])), F.to_date(F.lit(base[1])))
    stats = rows.groupBy("county_fips").agg(
        F.countDistinct("date").alias("_days"),
        rsem.mean_skip(F.when(in_base, F.col("device_count"))).alias("initial_device_count"))
    ensure_checkpoint_dir(rows.sparkSession)
    covered = stats.filter(F.col("_days") == n_days).drop("_days").checkpoint()
    # pass 2: rows of covered counties with their base attached.  The counties are
    # written once and counted, so that up to COUNTIES_SENT of them reach the rows
    # by broadcast and no block-group day is shuffled (all days of a county would
    # go to one task); beyond that the join shuffles
    rows = rows.join(joins.broadcast_if_small(covered, COUNTIES_SENT), "county_fips", "inner")
    rows = rows.withColumns({
        "share_of_devices": 1 - rsem.safe_div("completely_home_device_count", "device_count"),
        "share_of_candidate_devices":
            1 - rsem.safe_div("completely_home_device_count", "candidate_device_count"),
    })
    num = rsem.clip_low0(F.col("completely_home_device_count") + F.col("initial_device_count")
                         - F.col("device_count"))
    rows = rows.withColumn("share_adj_attrition",
                           1 - rsem.safe_div(num, F.col("initial_device_count")))
    daily = rows.groupBy("county_fips", "date").agg(
        rsem.sum_skip("device_count").alias("device_count"),
        rsem.sum_skip("completely_home_device_count").alias("completely_home_device_count"),
        rsem.mean_skip("share_of_devices").alias("share_of_devices"),
        rsem.mean_skip("share_of_candidate_devices").alias("share_of_candidate_devices"),
        rsem.mean_skip("share_adj_attrition").alias("share_adj_attrition"),
        rsem.weighted_mean("device_count", "median_home_dwell_time", strict=True)
        .alias("median_home_dwell_time"),
        rsem.weighted_mean("device_count", "median_non_home_dwell_time", strict=True)
        .alias("median_non_home_dwell_time"))
    daily = _finish(daily, "date")

    wk = daily.filter(F.col("date") <= F.to_date(F.lit(last_day))) \
        .withColumn("week_start_date", cal.week_start("date"))
    weekly = wk.groupBy("county_fips", "week_start_date").agg(
        rsem.sum_skip("device_count").alias("device_count"),
        rsem.sum_skip("completely_home_device_count").alias("completely_home_device_count"),
        rsem.mean_skip("share_of_devices").alias("share_of_devices"),
        rsem.mean_skip("share_of_candidate_devices").alias("share_of_candidate_devices"),
        rsem.mean_skip("share_adj_attrition").alias("share_adj_attrition"),
        rsem.weighted_mean("device_count", "median_home_dwell_time", strict=False)
        .alias("median_home_dwell_time"),
        rsem.weighted_mean("device_count", "median_non_home_dwell_time", strict=False)
        .alias("median_non_home_dwell_time"))
    weekly = weekly.filter(F.col("week_start_date") >= F.to_date(F.lit(first_week)))
    return {"daily": daily, "weekly": _finish(weekly, "week_start_date")}
