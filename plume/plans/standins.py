"""Driver queries: each re-expresses one group of the reference's operators on
the shared driver tables (roles in ``plume.plans.common``).  Every query reads
whole tables; none filters ids or caps rows.  SQL oracles are in
``plume.plans.oracle`` under the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.functions import calendar as cal
from plume.functions import rsem
from plume.functions import strings as st
from plume.operators import aggregate as agg
from plume.operators import joins, policy, rank, shape, spatial, window
from plume.plans.common import (BASE_WEEK, STUDY_END, STUDY_START, r6, table,
                                user_daily, user_weekly)
from plume.stats import event_study as es
from plume.stats import regress

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _events(spark, d):
    return table(spark, d, "events")


def _daily(spark, d):
    return user_daily(_events(spark, d))


# --- roll-ups, calendar, spine -------------------------------------------------

def daily_rollup(spark: SparkSession, d: str) -> DataFrame:
    x = _daily(spark, d)
    return x.select("user_id", "day", "n_events", r6("total_value").alias("total_value"),
                    r6("mean_value").alias("mean_value"))


def weekly_rollup(spark, d):
    w = user_weekly(_daily(spark, d))
    return w.select("user_id", "week_start", "n_days", "n_events",
                    r6("total_value").alias("total_value"),
                    r6("mean_daily_mean").alias("mean_daily_mean"))


def week_of_year_label(spark, d):
    ev = _events(spark, d).withColumn("day", F.to_date("ts"))
    return ev.groupBy("day").agg(F.count(F.lit(1)).alias("n_events")).select(
        "day", cal.r_week("day").cast("long").alias("week_of_year"),
        cal.week_start("day").alias("week_start"), "n_events")


def date_spine_fill(spark, d):
    daily = _daily(spark, d)
    users = _events(spark, d).select("user_id")
    spine = shape.date_spine(users, STUDY_START, STUDY_END, "day")
    out = joins.left_join(spine, daily.select("user_id", "day", "n_events", "total_value"),
                          ["user_id", "day"])
    return out.select("user_id", "day",
                      F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events"),
                      r6(F.coalesce("total_value", F.lit(0.0))).alias("total_value"))


def two_grain_counts(spark, d):
    ev = _events(spark, d).withColumn("week_start", cal.week_start(F.to_date("ts")))
    out = agg.two_grain(
        ev, ["user_id", "week_start"], ["event_type"],
        {"n_events": F.count(F.lit(1)), "total_value": rsem.sum_skip("value", real=True)},
        {"n_events": F.sum("n_events"), "total_value": rsem.exact_sum("total_value")})
    return out.select("user_id", "event_type", "week_start", F.col("n_events").cast("long"),
                      r6("total_value").alias("total_value"))


# --- weighted means, ratios, strict / skipping sums ---------------------------------

def weighted_mean_joinback(spark, d):
    """Quantity-weighted mean discount and tax per customer-year.

    Line items are pre-aggregated per order (map-side combined) before the
    join with orders, so only one row per order crosses the join shuffle.
    Weighted numerators are accumulated as exact integer hundredths, so the
    result does not depend on summation order (partitioning, retries).
    """
    li = table(spark, d, "lineitem")
    tax = F.when(F.col("l_tax") != 0, F.col("l_tax"))  # zero tax read as missing

    def cents(x):
        return F.floor(F.col("l_quantity") * x * 100 + 0.5)

    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("sq"),
        F.sum(cents(F.col("l_discount"))).alias("sqd"),
        F.sum(cents(tax)).alias("sqt"),
        F.count(F.lit(1)).alias("nr"),
        F.count(cents(tax)).alias("nt"))
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
        F.year("o_orderdate").cast("long").alias("order_year"))
    j = per_order.join(orders, "l_orderkey")
    g = j.groupBy("o_custkey", "order_year").agg(
        F.sum("sq").alias("sq"), F.sum("sqd").alias("sqd"), F.sum("sqt").alias("sqt"),
        F.sum("nr").alias("nr"), F.sum("nt").alias("nt"))
    den = F.col("sq") * 100

    def ratio(num):
        return F.try_divide(num.cast("double"), den)

    return g.select(
        "o_custkey", "order_year", r6("sq").alias("total_qty"),
        r6(ratio(F.col("sqd"))).alias("wmean_discount"),
        r6(ratio(F.when(F.col("nt") == F.col("nr"), F.col("sqt")))).alias("wmean_tax_strict"),
        r6(ratio(F.coalesce("sqt", F.lit(0)))).alias("wmean_tax_skip"))


def mean_of_ratios_vs_ratio_of_sums(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy("l_suppkey").agg(
        r6(rsem.exact_mean(rsem.safe_div("l_tax", "l_discount"))).alias("mean_of_ratios"),
        r6(rsem.safe_div(rsem.exact_sum("l_tax"), rsem.exact_sum("l_discount"))).alias("ratio_of_sums"),
        r6(rsem.safe_div(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
                               .otherwise(0.0)), F.sum("l_quantity"))).alias("share_returned"))


def _nullable_value():
    return F.when(F.col("event_type") != "error", F.col("value"))


def strict_sum_nulls(spark, d):
    ev = _events(spark, d).withColumn("v", _nullable_value())
    return ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        r6(rsem.sum_strict("v", real=True)).alias("strict_sum"),
        (F.count(F.lit(1)) - F.count("v")).alias("n_missing"))


def skip_sum_nulls(spark, d):
    ev = _events(spark, d).withColumn("v", _nullable_value())
    return ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        r6(rsem.sum_skip("v", real=True)).alias("skip_sum"),
        r6(rsem.mean_skip("v")).alias("mean_skip"))


def null_group(spark, d):
    ev = _events(spark, d).withColumn("k", F.when(F.col("event_type") != "error",
                                                  F.col("event_type")))
    return ev.groupBy("k").agg(F.count(F.lit(1)).alias("n_events"),
                               r6(rsem.sum_skip("value", real=True)).alias("total_value"))


def null_safe_left_join(spark, d):
    ev = _events(spark, d).withColumn("k", F.when(F.col("event_type") != "error",
                                                  F.col("event_type")))
    per_k = ev.groupBy("k").agg(F.count(F.lit(1)).alias("k_events"))
    out = rsem.left_join_na(ev.select("event_id", "k"), per_k, ["k"])
    return out.select("event_id", "k", "k_events")


# --- strings ----------------------------------------------------------------------

def fips_pad_key(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    j = joins.join_renamed(c.select("c_custkey", "c_nationkey"), n.select("n_nationkey"),
                           {"c_nationkey": "n_nationkey"})
    fips = F.concat(rsem.zpad("c_nationkey", 2), rsem.zpad("c_custkey", 3))
    j = j.withColumn("fips", fips)
    return j.select("c_custkey", "fips",
                    st.str_sub("fips", 1, 2).alias("state_code"),
                    st.str_sub("fips", 3).alias("county_code"),
                    st.str_sub("fips", -3, -1).alias("last3"),
                    rsem.try_cast("fips", "bigint").alias("key_num"))


def clean_names(spark, d):
    p = table(spark, d, "part")
    out = st.separate(p.select("p_partkey", "p_brand", "p_type", "p_name"), "p_name",
                      ["name_1", "name_2"])
    return out.select("p_partkey",
                      F.lower(F.trim("p_brand")).alias("brand_lower"),
                      F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).alias("brand_num"),
                      st.before_first("p_brand", "#").alias("brand_prefix"),
                      st.clean_county(F.concat(F.col("p_type"), F.lit(" County"))).alias("type_clean"),
                      "name_1", "name_2")


# --- reshape ------------------------------------------------------------------------

def _per_user_type(spark, d):
    return _events(spark, d).groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"))


def pivot_long_to_wide(spark, d):
    wide = shape.pivot_wide(_per_user_type(spark, d), ["user_id"], "event_type", "n",
                            EVENT_TYPES)
    return wide.select("user_id", *[F.coalesce(F.col(t), F.lit(0)).cast("long").alias(f"n_{t}")
                                    for t in EVENT_TYPES])


def unpivot_wide_to_long(spark, d):
    per_user = _events(spark, d).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), rsem.exact_sum("value").alias("total_value"),
        F.max("value").alias("max_value"))
    long = shape.unpivot_long(per_user, ["user_id"], ["n_events", "total_value", "max_value"],
                              "measure", "value")
    return long.select("user_id", "measure", r6("value").alias("value"))


def json_map_first(spark, d):
    ev = _events(spark, d)
    k, v = st.json_first_entry(F.col("props"))
    poi_key = F.when(F.col("event_type").isin("click", "view"), F.lit("k")).otherwise(F.lit("z"))
    total = F.floor("value").cast("long")
    out = ev.select("event_id", k.alias("first_key"), v.cast("long").alias("first_count"),
                    poi_key.alias("poi_key"), total.alias("total"))
    cnt = F.coalesce(F.col("first_count"), F.lit(0).cast("long"))
    same = rsem.r_ifelse(F.col("first_key") == F.col("poi_key"), cnt, F.lit(0).cast("long"))
    out = out.withColumn("same_cbg", rsem.pmin("total", same))
    return out.select("event_id", "first_key", "first_count", "same_cbg",
                      (F.col("total") - F.col("same_cbg")).alias("diff_cbg"))


def array_explode_days(spark, d):
    """R4 round trip: per (user, Monday week) a 7-day '[n,...]' text built from
    events, parsed back to one row per day."""
    daily = _daily(spark, d).withColumn("week_start", cal.week_start("day"))
    weeks = daily.select("user_id", "week_start").distinct()
    days = weeks.withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(6)))) \
        .withColumn("day", F.date_add("week_start", F.col("pos")))
    counts = days.join(daily.select("user_id", "day", "n_events"), ["user_id", "day"], "left") \
        .withColumn("n", F.coalesce("n_events", F.lit(0)))
    text = counts.groupBy("user_id", "week_start").agg(
        F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("arr")) \
        .withColumn("visits_by_day", F.concat(
            F.lit("["), F.array_join(F.transform("arr", lambda s: s["n"].cast("string")), ","),
            F.lit("]"))).drop("arr")
    out = shape.explode_daily_array(text, "visits_by_day", "week_start", "day", "visits")
    return out.select("user_id", "day", F.col("visits").cast("long").alias("visits"))


# --- coverage, semi/anti, scalar override -----------------------------------------

def coverage_filter(spark, d):
    daily = _daily(spark, d)
    good = agg.coverage_keys(daily, ["user_id"], "day")
    return joins.semi(daily, good, ["user_id"]).select("user_id", "day", "n_events")


def ever_treated_semi(spark, d):
    ev = _events(spark, d)
    daily = _daily(spark, d)
    treat = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.max(F.when((F.col("event_type") == "purchase") & (F.col("value") > 200), 1)
              .otherwise(0)).alias("treated"))
    ever = treat.groupBy("user_id").agg(F.max("treated").alias("ever")).filter(F.col("ever") > 0)
    return joins.semi(daily, ever, ["user_id"]).select("user_id", "day", "n_events")


def scalar_override(spark, d):
    """Merge the BUILDING customers of nation 3 into one row whose
    balance is their total (the city-counties merge), replacing the parts."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment",
                                           "c_acctbal")
    part = (F.col("c_nationkey") == 3) & (F.col("c_mktsegment") == "BUILDING")
    merged = c.filter(part).groupBy("c_nationkey", "c_mktsegment").agg(
        rsem.exact_sum("c_acctbal").alias("c_acctbal")).withColumn("c_custkey", F.lit(-1).cast("long"))
    kept = c.filter(~part)
    out = shape.append_rows(kept, merged)
    return out.select("c_custkey", "c_nationkey", "c_mktsegment", r6("c_acctbal").alias("c_acctbal"))


# --- policy interval flags ---------------------------------------------------------

def _policy_daily(spark, d):
    ev = _events(spark, d).withColumn("day", F.to_date("ts")) \
        .withColumn("state_id", F.floor(F.col("user_id") / 10).cast("long"))
    st_dates = ev.groupBy("state_id").agg(
        F.min(F.when((F.col("event_type") == "signup") & (F.col("value") > 150), F.col("day")))
        .alias("state_sip_start_date"),
        F.max(F.when((F.col("event_type") == "error") & (F.col("value") > 250), F.col("day")))
        .alias("state_sip_end_date"))
    co_dates = ev.groupBy("user_id").agg(
        F.first("state_id").alias("state_id"),
        F.min(F.when((F.col("event_type") == "purchase") & (F.col("value") > 150), F.col("day")))
        .alias("county_sip_start_date"),
        F.max(F.when((F.col("event_type") == "click") & (F.col("value") > 250), F.col("day")))
        .alias("county_sip_end_date"))
    spine = shape.date_spine(co_dates.select("user_id", "state_id"), STUDY_START, STUDY_END, "day")
    spine = spine.join(co_dates.drop("state_id"), "user_id", "left") \
        .join(st_dates, "state_id", "left")
    return policy.daily_flags(spine, "day")


def policy_interval_flag(spark, d):
    x = _policy_daily(spark, d)
    return x.select("user_id", "day", F.col("state_sip").cast("long"),
                    F.col("county_sip").cast("long"), F.col("sip_binary").cast("long"))


def policy_weekly_days(spark, d):
    w = policy.weekly_days(_policy_daily(spark, d), ["user_id"], "day")
    return w.select("user_id", "week_start_date", F.col("sip_days").cast("long"),
                    F.col("weekly_sipo_binary").cast("long"))


# --- joins ----------------------------------------------------------------------------

def star_left_chain(spark, d, check_unique: bool = False):
    """Orders <- line totals <- customer <- nation <- region."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        rsem.exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")) \
        .withColumnsRenamed({"l_orderkey": "o_orderkey"})
    orders = table(spark, d, "orders").drop("o_orderstatus", "o_orderpriority")
    cust = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    nation = table(spark, d, "nation").withColumnsRenamed(
        {"n_nationkey": "c_nationkey", "n_name": "nation"})
    region = table(spark, d, "region").withColumnsRenamed(
        {"r_regionkey": "n_regionkey", "r_name": "region"})
    out = joins.chain(orders, [(li, ["o_orderkey"]), (cust, ["o_custkey"]),
                               (nation, ["c_nationkey"]), (region, ["n_regionkey"])],
                      check_unique=check_unique)
    out = out.withColumnsRenamed({"c_name": "customer_name"}) \
        .withColumn("order_date", F.to_date("o_orderdate")) \
        .drop("o_orderdate", "o_totalprice", "c_nationkey", "n_regionkey", "o_custkey")
    out = shape.front(out, "o_orderkey", "customer_name")
    return out.select("o_orderkey", "customer_name", "nation", "region", "order_date",
                      F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                      r6("revenue").alias("revenue"))


def renamed_key_inner(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")
    return joins.join_renamed(c, n, {"c_nationkey": "n_nationkey"}) \
        .select("c_custkey", "c_nationkey", "n_name", "n_regionkey")


# Fixed polygons of the point-in-polygon stand-in (state, county, ring, seq, x, y)
RECTS = [
    ("s1", "c1", 0.0, 0.0, 2000.0, 3000.0),
    ("s1", "c2", 2500.0, 1000.0, 5000.0, 6000.0),
    ("s2", "c3", 6000.0, 5000.0, 9000.0, 9000.0),
    ("s2", "c4", -1000.0, 2000.0, -100.0, 8000.0),
]


def rect_vertices(spark):
    rows = []
    for s, c, x0, y0, x1, y1 in RECTS:
        for i, (x, y) in enumerate([(x0, y0), (x1, y0), (x1, y1), (x0, y1)]):
            rows.append((s, c, 1, i + 1, x, y))
    return spark.createDataFrame(rows, "state string, county string, ring int, seq int, "
                                       "lon double, lat double")


def point_in_rect(spark, d):
    c = table(spark, d, "customer")
    pts = c.select("c_custkey", F.col("c_acctbal").alias("x"),
                   (F.col("c_nationkey") * 400 + F.col("c_custkey") / 100).cast("double").alias("y"))
    out = spatial.points_to_polygons(pts, rect_vertices(spark), "x", "y", ["c_custkey"],
                                     cell=1000.0)
    return out.select("c_custkey", "x", "y", "state", "county")


# Fixed polygons of the general point-in-polygon stand-in: (state, county, [(x, y), ...])
POLYGONS = [
    ("t1", "tri", [(0.0, 0.0), (3000.0, 0.0), (0.0, 3000.0)]),
    ("t1", "pent", [(4000.0, 1000.0), (6000.0, 1000.0), (7000.0, 3000.0), (5000.0, 5000.0),
                    (3500.0, 3000.0)]),
    ("t2", "quad", [(6000.0, 5000.0), (9500.0, 6000.0), (9000.0, 9000.0), (6500.0, 8500.0)]),
]


def point_in_polygon(spark, d):
    """J7 with non-rectangular polygons: ray casting, edges included."""
    rows = [(s_, c, 1, i + 1, x, y) for s_, c, pts in POLYGONS for i, (x, y) in enumerate(pts)]
    verts = spark.createDataFrame(rows, "state string, county string, ring int, seq int, "
                                        "lon double, lat double")
    c = table(spark, d, "customer")
    pts = c.select("c_custkey", F.col("c_acctbal").alias("x"),
                   (F.col("c_nationkey") * 400 + F.col("c_custkey") / 100).cast("double").alias("y"))
    out = spatial.points_to_polygons(pts, verts, "x", "y", ["c_custkey"], cell=1000.0)
    return out.select("c_custkey", "x", "y", "state", "county")


# --- windows -----------------------------------------------------------------------------

def lags_leads(spark, d):
    w = user_weekly(_daily(spark, d)).select("user_id", "week_start", "total_value")
    out = window.lags_leads(w, "total_value", "user_id", "week_start")
    cols = ["total_value", "lag1", "lag2", "lag3", "lead1", "lead2", "lead3"]
    return out.select("user_id", "week_start", *[r6(c).alias(c) for c in cols])


def _spine_values(spark, d):
    daily = _daily(spark, d).select("user_id", "day", F.col("mean_value").alias("v"))
    spine = shape.date_spine(_events(spark, d).select("user_id"), STUDY_START, STUDY_END, "day")
    return spine.join(daily, ["user_id", "day"], "left")


def fill_down(spark, d):
    x = _spine_values(spark, d)
    return x.select("user_id", "day", r6(window.fill_down("v", "user_id", "day")).alias("v_filled"))


def fill_up(spark, d):
    x = _spine_values(spark, d)
    return x.select("user_id", "day", r6(window.fill_up("v", "user_id", "day")).alias("v_filled"))


def fill_both(spark, d):
    x = _spine_values(spark, d)
    return x.select("user_id", "day", r6(window.fill_both("v", "user_id", "day")).alias("v_filled"))


def event_time(spark, d):
    daily = _daily(spark, d)
    out = window.event_time(daily, "error_flag", "user_id", "day", "since_start", "since_end",
                            index_col="day_index")
    return out.select("user_id", "day", F.col("error_flag").cast("long"),
                      F.col("day_index").cast("long"), F.col("since_start").cast("long"),
                      F.col("since_end").cast("long"))


def base_week_index(spark, d):
    w = user_weekly(_daily(spark, d))
    out = window.base_index(w, "total_value", "week_start", F.to_date(F.lit(BASE_WEEK)),
                            "user_id", out_col="value_index")
    return out.select("user_id", "week_start", r6("value_index").alias("value_index"))


def event_base_index(spark, d):
    """M2 event form + D16 map decile: n_events relative to day -3 of the
    start, down-only fill, then a global decile of the ratio (N12)."""
    daily = _daily(spark, d)
    et = window.event_time(daily, "error_flag", "user_id", "day", "since_start", "since_end")
    et = et.filter(F.col("since_start").isNotNull())
    idx = window.base_index(et, "n_events", "since_start", -3, "user_id",
                            order=["since_start", "day"], out_col="x_index")
    dec = rank.ntile(idx.select("user_id", "day", "since_start", "x_index"), 10, "x_index",
                     ["user_id", "day"], out_col="decile")
    return dec.select("user_id", "day", F.col("since_start").cast("long"),
                      r6("x_index").alias("x_index"), F.col("decile").cast("long"))


def ntile_partitioned(spark, d):
    o = table(spark, d, "orders").withColumn(
        "price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    out = rank.ntile(o.select("o_orderkey", "o_orderpriority", "price"), 10, "price",
                     ["o_orderkey"], ["o_orderpriority"], out_col="decile")
    return out.select("o_orderkey", "o_orderpriority", F.col("decile").cast("long"))


def ntile_null_group(spark, d):
    """W10 where the group is null for one priority: its rows are a group too."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice",
        F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")).alias("grp"))
    out = rank.ntile(o, 10, "o_totalprice", ["o_orderkey"], ["grp"], out_col="decile")
    return out.select("o_orderkey", "grp", F.col("decile").cast("long"))


def ntile_global(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    out = rank.ntile(c, 100, "c_acctbal", ["c_custkey"], out_col="pct")
    return out.select("c_custkey", F.col("pct").cast("long"))


def decile_one_hot(spark, d):
    x = ntile_partitioned(spark, d)
    out = shape.one_hot(x, "decile", list(range(1, 11)), name="decile_{level}")
    return out.select("o_orderkey", "decile",
                      *[F.col(f"decile_{i}").cast("long") for i in range(1, 11)])


# --- quantiles, profiles, logs ------------------------------------------------------------

def quantile_gap(spark, d):
    c = table(spark, d, "customer").select("c_mktsegment", "c_acctbal")
    probs, names = [0.1, 0.5, 0.9], ["q10", "median", "q90"]
    by_seg = rank.quantiles(c, "c_acctbal", probs, ["c_mktsegment"], names=names)
    overall = rank.quantiles(c, "c_acctbal", probs, names=names)
    out = shape.union_all([by_seg, overall])
    return out.select("c_mktsegment", r6("q10").alias("q10"), r6("median").alias("median"),
                      r6("q90").alias("q90"), r6(F.col("q90") - F.col("q10")).alias("gap_90_10"))


def median_split_trend(spark, d):
    """M7 + W12 + D15: mean order value by above/below-median balance and
    year, relative to the group's first year."""
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    med = rank.quantiles(c, "c_acctbal", [0.5], names=["median"]).collect()[0]["median"]
    cs = c.select(F.col("c_custkey").alias("o_custkey"),
                  F.when(F.col("c_acctbal") > F.lit(med), 1).otherwise(0).cast("long")
                  .alias("above_median"))
    o = table(spark, d, "orders").select("o_custkey", "o_totalprice",
                                         F.year("o_orderdate").cast("long").alias("order_year"))
    j = o.join(cs, "o_custkey")
    out = window.group_base_index(j, ["o_totalprice"], ["above_median"], "order_year", 1995)
    return out.select("above_median", "order_year", r6("o_totalprice").alias("mean_total"),
                      r6("o_totalprice_index").alias("mean_total_index"))


def attrition_share(spark, d):
    """M1/H5/A12/M3 on (user, event_type, day) rows: devices = events, home =
    events with value < 10, init = the user's mean devices in the first week."""
    ev = _events(spark, d).withColumn("day", F.to_date("ts"))
    rows = ev.groupBy("user_id", "event_type", "day").agg(
        F.count(F.lit(1)).alias("devices"),
        F.count(F.when(F.col("value") < 10, 1)).alias("home"))
    init = rows.filter(F.col("day").between(F.to_date(F.lit("2024-01-01")),
                                            F.to_date(F.lit("2024-01-07")))) \
        .groupBy("user_id").agg(F.avg("devices").alias("init"))
    r = rows.join(init, "user_id", "left")
    num = rsem.clip_low0(F.col("home") + F.col("init") - F.col("devices"))
    r = r.withColumns({"share_adj": 1 - rsem.safe_div(num, F.col("init")),
                       "share_dev": 1 - rsem.safe_div(F.col("home"), F.col("devices"))})
    out = r.groupBy("user_id", "day").agg(
        r6(rsem.mean_skip("share_adj")).alias("share_adj_attrition"),
        r6(rsem.mean_skip("share_dev")).alias("share_of_devices"),
        (F.sum("devices") - F.sum("home")).alias("devices_leaving_home"))
    return out


def _profiled_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_totalprice"), F.col("o_custkey").cast("double").alias("o_custkey"),
                    F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))
                    .alias("open_price"))


def column_profile(spark, d):
    prof = agg.column_profile(_profiled_orders(spark, d),
                              ["o_totalprice", "o_custkey", "open_price"])
    return prof.select("column", "n", *[r6(c).alias(c) for c in
                                        ["min", "q1", "median", "mean", "q3", "max"]],
                       "nulls", r6("null_share").alias("null_share"))


def log_transforms(spark, d):
    o = table(spark, d, "orders")
    g = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), rsem.exact_mean("o_totalprice").alias("mean_total"),
        rsem.exact_mean(rsem.log1p("o_totalprice")).alias("mean_log_total"))
    return g.select("o_custkey", "n_orders", r6("mean_total").alias("mean_total"),
                    r6(rsem.log1p("mean_total")).alias("log_mean_total"),
                    r6("mean_log_total").alias("mean_log_total"),
                    r6(F.expm1("mean_log_total")).alias("geo_mean_total"))


# --- estimators ---------------------------------------------------------------------------

def _coef_frame(spark, rows):
    return spark.createDataFrame(rows, "model string, term string, estimate double") \
        .select("model", "term", r6("estimate").alias("estimate"))


def ols_pooled(spark, d):
    li = table(spark, d, "lineitem")
    a = regress.ols(li, "l_extendedprice", ["l_quantity"], intercept=True)
    b = regress.ols(li, "l_extendedprice", ["l_quantity"], intercept=False)
    rows = [("with_intercept", t, float(v)) for t, v in zip(a.terms, a.coef)] + \
           [("no_intercept", t, float(v)) for t, v in zip(b.terms, b.coef)]
    return _coef_frame(spark, rows)


def _fe_panel(spark, d):
    return _daily(spark, d).select("user_id", "day", F.col("total_value").alias("y"),
                                   F.col("n_events").cast("double").alias("x"))


def within_fe(spark, d):
    fit = regress.within(_fe_panel(spark, d), "y", ["x"], "user_id", cluster=None)
    return spark.createDataFrame(
        [(fit.terms[0], float(fit.coef[0]), fit.n_obs, fit.n_groups)],
        "term string, estimate double, n_obs long, n_groups long") \
        .select("term", r6("estimate").alias("estimate"), "n_obs", "n_groups")


def cluster_se(spark, d):
    fit = regress.within(_fe_panel(spark, d), "y", ["x"], "user_id")
    t = fit.table()[0]
    return spark.createDataFrame(
        [(t["term"], t["estimate"], t["std_error"], t["statistic"], fit.n_obs, fit.n_groups)],
        "term string, estimate double, std_error double, statistic double, n_obs long, "
        "n_clusters long").select(
        "term", *[r6(c).alias(c) for c in ["estimate", "std_error", "statistic"]],
        "n_obs", "n_clusters")


def two_way_fe(spark, d):
    daily = _daily(spark, d).select("user_id", "day", "n_events", "total_value")
    spine = shape.date_spine(_events(spark, d).select("user_id"), STUDY_START, STUDY_END, "day")
    bal = spine.join(daily, ["user_id", "day"], "left").select(
        "user_id", "day", F.coalesce("total_value", F.lit(0.0)).alias("y"),
        F.coalesce("n_events", F.lit(0)).cast("double").alias("x"))
    fit = regress.two_way_within(bal, "y", ["x"], "user_id", "day")
    return spark.createDataFrame([(fit.terms[0], float(fit.coef[0]))],
                                 "term string, estimate double") \
        .select("term", r6("estimate").alias("estimate"))


def two_way_fe_unbalanced(spark, d):
    """Users and the days they have events on; ``z`` is constant within a user
    and must be found swept out."""
    panel = _daily(spark, d).select(
        "user_id", "day", F.col("total_value").alias("y"), F.col("n_events").cast("double").alias("x"),
        F.sqrt(F.col("user_id") + F.lit(0.5)).alias("z"))
    fit = regress.two_way_within(panel, "y", ["x", "z"], "user_id", "day")
    return spark.createDataFrame([(t, float(b), fit.n_obs, fit.n_groups) for t, b in zip(fit.terms, fit.coef)],
                                 "term string, estimate double, n_obs long, n_groups long") \
        .withColumn("estimate", r6("estimate"))


def weekly_slope_sweep(spark, d):
    daily = _daily(spark, d).withColumn("week_start", cal.week_start("day")) \
        .withColumn("x", F.col("n_events").cast("double"))
    out = es.slope_sweep(daily, "total_value", "x", "week_start")
    return out.select("week_start", r6("slope").alias("slope"),
                      r6("intercept").alias("intercept"), F.col("n_obs").cast("long"))


def _welch(spark, d):
    o = table(spark, d, "orders").withColumn("order_year", F.year("o_orderdate").cast("long"))
    return es.welch(o, "o_totalprice", "o_orderstatus", "order_year", "F", "O")


def welch_ci(spark, d):
    w = _welch(spark, d)
    return w.select("order_year", F.col("n_a").cast("long"), F.col("n_b").cast("long"),
                    *[r6(c).alias(c) for c in ["mean_a", "mean_b", "diff", "se", "df"]])


def welch_ci_bounds(spark, d):
    o = table(spark, d, "orders").withColumn("order_year", F.year("o_orderdate").cast("long"))
    w = es.welch_ci(o, "o_totalprice", "o_orderstatus", "order_year", "F", "O")
    return w.select("order_year", *[r6(c).alias(c) for c in ["diff", "se", "ci_low", "ci_high"]])


def _weekly_event_panel(spark, d):
    """Flagship slice: events -> user-day -> Monday week -> 0/1 flag -> event
    time -> base-week index (A1, A3, A9, T3, W4, W6-W8, W13, W14, M2)."""
    ev = _events(spark, d)
    daily = user_daily(ev)
    errors = ev.filter(F.col("event_type") == "error").groupBy(
        "user_id", cal.week_start(F.to_date("ts")).alias("week_start")).agg(
        F.count(F.lit(1)).alias("n_errors"))
    weekly = user_weekly(daily).join(errors, ["user_id", "week_start"], "left") \
        .withColumn("n_errors", F.coalesce("n_errors", F.lit(0)))
    weekly = weekly.withColumn("flag", F.when(F.col("n_errors") >= 4, 1).otherwise(0))
    et = window.event_time(weekly, "flag", "user_id", "week_start")
    et = window.base_index(et, "total_value", "week_start", F.to_date(F.lit(BASE_WEEK)),
                           "user_id", out_col="value_index")
    return et.withColumn("log_total_value", rsem.log1p("total_value"))


def flagship_event_panel(spark, d):
    et = _weekly_event_panel(spark, d)
    return et.select("user_id", "week_start", F.col("n_errors").cast("long"),
                     F.col("flag").cast("long"),
                     F.col("weeks_since_start").cast("long"), F.col("weeks_since_end").cast("long"),
                     r6("total_value").alias("total_value"), r6("value_index").alias("value_index"))


def event_study_table(spark, d):
    panel = _weekly_event_panel(spark, d).withColumn(
        "n_days", F.col("n_days").cast("double"))
    specs = [es.Spec("start_plain", "log_total_value", "weeks_since_start"),
             es.Spec("start_controls", "log_total_value", "weeks_since_start", ["n_days"]),
             es.Spec("end_plain", "log_total_value", "weeks_since_end"),
             es.Spec("end_controls", "log_total_value", "weeks_since_end", ["n_days"])]
    return _rounded_table(es.sweep(spark, panel, specs, "user_id"))


def event_study_lags(spark, d):
    """Designs with a lag and a lead: each user's first and last week leave the
    complete rows, and with them the lowest event levels."""
    panel = _weekly_event_panel(spark, d).withColumn("n_days", F.col("n_days").cast("double"))
    panel = window.lags_leads(panel, "log_total_value", "user_id", "week_start")
    specs = [es.Spec(f"{side}_lags", "log_total_value", f"weeks_since_{side}", ["n_days", "lag1", "lead1"])
             for side in ("start", "end")]
    return _rounded_table(es.sweep(spark, panel, specs, "user_id"))


def _rounded_table(t):
    return t.select("model", "term_order", "term", "stars", *[
        r6(c).alias(c) for c in ["estimate", "std_error", "statistic", "p_value",
                                 "percent_difference", "low", "high"]])


# --- the distancing pipeline (D4) itself, on a device table derived from events ---

def device_days(spark, d):
    """Stand-in ``device_daily`` rows: block group = user x event type (the
    user's 5-digit code is the county), one row per day; devices = events,
    at home = events with value < 10, dwell medians = mean and max value."""
    ev = _events(spark, d)
    g = ev.groupBy("user_id", _type_code().alias("bg"), F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("device_count"),
        F.count(F.when(F.col("value") < 10, 1)).alias("completely_home_device_count"),
        rsem.exact_mean("value").alias("median_home_dwell_time"),
        F.max("value").alias("median_non_home_dwell_time"))
    # numeric block-group ids lose their leading zeros, as when read by fread
    return g.select(
        (F.col("user_id") * 10000000 + F.col("bg")).cast("string").alias("origin_census_block_group"),
        F.concat(F.col("day").cast("string"), F.lit("T00:00:00-05:00")).alias("date_range_start"),
        "device_count", "completely_home_device_count", "median_home_dwell_time",
        "median_non_home_dwell_time",
        (F.col("device_count") + 2).alias("candidate_device_count"))


def _distancing(spark, d):
    from plume.sources.mobility import distancing
    return distancing(device_days(spark, d), n_days=30, base=(STUDY_START, "2024-01-07"),
                      last_day=STUDY_END, first_week=STUDY_START)


_DIST_MEASURES = ["log_devices_leaving_home", "median_home_dwell_time",
                  "log_median_home_dwell_time", "median_non_home_dwell_time",
                  "log_median_non_home_dwell_time", "share_of_devices",
                  "share_of_candidate_devices", "share_adj_attrition"]


def distancing_daily_build(spark, d):
    x = _distancing(spark, d)["daily"]
    return x.select("county_fips", "date", "device_count", "completely_home_device_count",
                    "devices_leaving_home", *[r6(c).alias(c) for c in _DIST_MEASURES])


def distancing_weekly_build(spark, d):
    x = _distancing(spark, d)["weekly"]
    return x.select("county_fips", "week_start_date", "device_count",
                    "completely_home_device_count", "devices_leaving_home",
                    *[r6(c).alias(c) for c in _DIST_MEASURES])


# --- the POI patterns pipeline (D2) itself, on patterns derived from events --------

def _type_code():
    return F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "error", 2) \
        .when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 4) \
        .when(F.col("event_type") == "view", 5).otherwise(0)


def weekly_patterns(spark, d):
    """Stand-in ``weekly_patterns``: place = user x event type, one row per
    Monday week with the 7 daily counts as '[n,...]' text, visitors = active
    days, and a home map whose first entry is the place's own block group on
    even weeks (sum of props.k), another one on odd weeks, empty when the sum
    is a multiple of 5."""
    ev = _events(spark, d).withColumns({
        "day": F.to_date("ts"), "code": _type_code(),
        "k": F.get_json_object("props", "$.k").cast("long")})
    ev = ev.withColumn("week", cal.week_start("day"))
    per_day = ev.groupBy("user_id", "code", "week", "day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"))
    pw = per_day.groupBy("user_id", "code", "week").agg(
        F.map_from_entries(F.collect_list(F.struct(F.datediff("day", "week"), "n"))).alias("m"),
        F.sum("n").alias("raw_visit_counts"), F.count(F.lit(1)).alias("raw_visitor_counts"),
        F.sum("k").alias("sk"))
    days = F.transform(F.sequence(F.lit(0), F.lit(6)),
                       lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)).cast("string"))
    cbg = F.lpad(F.col("user_id").cast("string"), 12, "0")
    homes = F.when(F.col("sk") % 5 == 0, F.lit("{}")) \
        .when(F.col("sk") % 2 == 0, F.concat(F.lit('{"'), cbg, F.lit('": '),
                                             (F.col("sk") % 9).cast("string"),
                                             F.lit(', "999999999999": 1}'))) \
        .otherwise(F.concat(F.lit('{"888888888888": 3, "'), cbg, F.lit('": 2}')))
    return pw.select(
        F.concat(F.lit("p"), F.col("user_id").cast("string"), F.lit("-"),
                 F.col("code").cast("string")).alias("safegraph_place_id"),
        F.concat(F.col("week").cast("string"), F.lit("T00:00:00-05:00")).alias("date_range_start"),
        F.concat(F.lit("["), F.array_join(days, ","), F.lit("]")).alias("visits_by_day"),
        "raw_visit_counts", "raw_visitor_counts", cbg.alias("poi_cbg"),
        homes.alias("visitor_home_cbgs"))


def poi_lookup(spark, d):
    """Stand-in ``poi_counties``: five users per county, fifty per state."""
    ev = _events(spark, d).select("user_id", _type_code().alias("code")).distinct()
    return ev.select(
        F.concat(F.lit("p"), F.col("user_id").cast("string"), F.lit("-"),
                 F.col("code").cast("string")).alias("safegraph_place_id"),
        F.concat((F.col("code") + 10).cast("string"), F.lit("1110")).alias("naics_code"),
        F.concat(F.lit("st"), F.floor(F.col("user_id") / 50).cast("string")).alias("state"),
        F.concat(F.lit("co"), F.floor(F.col("user_id") / 5).cast("string")).alias("county"))


def _patterns(spark, d, mode="first"):
    from plume.sources.mobility import poi_patterns
    return poi_patterns(weekly_patterns(spark, d), poi_lookup(spark, d), mode)


def poi_weekly_build(spark, d):
    return _patterns(spark, d)["weekly"].select(
        "state", "county", "date_week_start", "total_visits", "total_visitors",
        "total_visitors_same_cbg", "total_visitors_diff_cbg")


def poi_weekly_naics_build(spark, d):
    """The NAICS grain, with the home map looked up by the place's own key (M4)."""
    return _patterns(spark, d, mode="lookup")["weekly_naics"].select(
        "state", "county", "naics", "date_week_start", "total_visits", "total_visitors",
        "total_visitors_same_cbg", "total_visitors_diff_cbg")


def poi_daily_build(spark, d):
    return _patterns(spark, d)["daily"].select(
        "state", "county", "date", F.col("total_visits").cast("long"))


def poi_daily_naics_build(spark, d):
    return _patterns(spark, d)["daily_naics"].select(
        "state", "county", "naics", "date", F.col("total_visits").cast("long"))


# --- the stay-home-order pipeline (D6) itself, on orders derived from customers -----

ORDER_SPINE = ("1998-01-26", "1998-05-31")   # 126 days from a Monday, as the reference's


def fold_day(day):
    """A day of the spine for any calendar day, 126 days apart: every row of a
    table has its place in the spine, whatever its year."""
    start = F.to_date(F.lit(ORDER_SPINE[0]))
    return F.date_add(start, F.pmod(F.datediff(day, start), F.lit(126)))


def _dearest_in(month):
    """Day of the dearest 1-URGENT order among those of one month."""
    return F.max_by("od", F.when((F.col("o_orderpriority") == "1-URGENT") & (F.month("od") == month),
                                 F.col("o_totalprice")))


def county_orders(spark, d):
    """Stand-in ``county_orders``: state = nation, county = customer; the local
    order starts at the customer's first 2-HIGH order (order days folded into
    the spine) and ends at its last 5-LOW order, the state order starts at the
    nation's dearest 1-URGENT order of March and ends at its dearest 1-URGENT
    order of April (``M/d/yyyy`` text, null when there is none)."""
    cust = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_name", "c_acctbal")
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")
    o = table(spark, d, "orders").select(
        "o_custkey", "o_orderpriority", "o_totalprice", fold_day(F.to_date("o_orderdate")).alias("od"))
    per_c = o.groupBy("o_custkey").agg(
        F.min(F.when(F.col("o_orderpriority") == "2-HIGH", F.col("od"))).alias("cs"),
        F.max(F.when(F.col("o_orderpriority") == "5-LOW", F.col("od"))).alias("ce"))
    per_n = o.join(cust.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey") \
        .groupBy("c_nationkey").agg(
            _dearest_in(3).alias("ss"), _dearest_in(4).alias("se"))
    fmt = lambda c: F.date_format(c, "M/d/yyyy")
    x = cust.join(nat, cust.c_nationkey == nat.n_nationkey) \
        .join(per_c, cust.c_custkey == per_c.o_custkey, "left") \
        .join(per_n, "c_nationkey", "left")
    none = F.lit(None).cast("string")
    return x.select(
        F.col("c_nationkey").cast("string").alias("state_code"),
        F.col("c_custkey").cast("string").alias("county_code"), F.lit("XX").alias("state"),
        F.col("n_name").alias("state_name"), F.concat("c_name", F.lit(" County")).alias("county_name"),
        F.floor(F.abs("c_acctbal")).cast("long").alias("popestimate2019"),
        fmt("ss").alias("state_sip_start_date"), fmt("se").alias("state_sip_end_date"),
        fmt("cs").alias("county_sip_start_date"), fmt("ce").alias("county_sip_end_date"),
        *[none.alias(f"citation{i}") for i in range(1, 6)])


def _orders_build(spark, d):
    from plume.sources.health import orders
    co = county_orders(spark, d)
    pop = co.select(F.col("state_code").alias("STATE"), F.col("county_code").alias("COUNTY"),
                    F.col("state_name").alias("STNAME"), F.col("county_name").alias("CTYNAME"),
                    F.col("popestimate2019").alias("POPESTIMATE2019"))
    return orders(co, pop, *ORDER_SPINE)


def orders_daily_build(spark, d):
    x = _orders_build(spark, d)["daily"]
    return x.select("county_fips", "state", "county", "date", "state_sip_start_date",
                    "state_sip_end_date", "county_sip_start_date", "county_sip_end_date",
                    F.col("state_sip").cast("long"), F.col("county_sip").cast("long"),
                    F.col("sip_binary").cast("long"))


def orders_weekly_build(spark, d):
    x = _orders_build(spark, d)["weekly"]
    return x.select("county_fips", "state", "county", "week_start_date", "state_sip_start_date",
                    "county_sip_end_date", F.col("sip_days").cast("long"),
                    F.col("weekly_sipo_binary").cast("long"))


# --- the cases pipeline (D5) itself, at nation grain (county = nation) -------------

def _nation_keys(spark, d):
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "r_name",
        F.concat(rsem.zpad("n_regionkey", 2), rsem.zpad("n_nationkey", 3)).alias("fips"))


def nation_cases_inputs(spark, d) -> dict:
    """Stand-in raw tables for the cases build: county = nation, state = region.

    cases / deaths = cumulative orders / 1-URGENT orders of the nation's
    customers by order date (whole orders table); population = summed
    balances, land area = 10 x customers, ACS age cells s1..s12 = customers
    in twelve balance bands from 5000 up, total = customers."""
    keys = _nation_keys(spark, d)
    cust = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    per_n = cust.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("nc"), F.floor(rsem.exact_sum(F.abs("c_acctbal"))).cast("long").alias("pop"),
        *[F.count(F.when(F.floor((F.col("c_acctbal") - 5000) / 417.0) == k - 1, 1)).alias(f"s{k}")
          for k in range(1, 13)])
    nk = keys.join(per_n, keys.n_nationkey == per_n.c_nationkey, "left")
    orders = nk.select(
        F.substring("fips", 1, 2).alias("state_code"), F.substring("fips", 3, 3).alias("county_code"),
        F.lit("XX").alias("state"), F.col("r_name").alias("state_name"),
        F.concat("n_name", F.lit(" County")).alias("county_name"),
        F.coalesce("pop", F.lit(0).cast("long")).alias("popestimate2019"),
        *[F.lit(None).cast("string").alias(c) for c in
          ["state_sip_start_date", "state_sip_end_date", "county_sip_start_date",
           "county_sip_end_date", "citation1", "citation2", "citation3", "citation4", "citation5"]])
    pop = orders.select(F.col("state_code").alias("STATE"), F.col("county_code").alias("COUNTY"),
                        F.col("state_name").alias("STNAME"), F.col("county_name").alias("CTYNAME"),
                        F.col("popestimate2019").alias("POPESTIMATE2019"))
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority",
                                         F.to_date("o_orderdate").alias("date"))
    daily = o.join(cust.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey") \
        .groupBy("c_nationkey", "date").agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("u"))
    from pyspark.sql import Window
    w = Window.partitionBy("c_nationkey").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    cum = daily.select("c_nationkey", "date", F.sum("n").over(w).alias("cases"),
                       F.sum("u").over(w).alias("deaths"))
    nyt = cum.join(keys, cum.c_nationkey == keys.n_nationkey).select(
        "date", F.col("n_name").alias("county"), F.col("r_name").alias("state"), "fips",
        "cases", "deaths")
    area = nk.select(F.concat("n_name", F.lit(", XX")).alias("Areaname"), F.col("fips").alias("STCOU"),
                     (F.coalesce("nc", F.lit(0)) * 10.0).alias("LND110200D"))
    cells = F.array(F.struct(F.lit("total").alias("variable"), F.col("nc").cast("double").alias("estimate")),
                    *[F.struct(F.lit(f"s{k}").alias("variable"),
                              F.col(f"s{k}").cast("double").alias("estimate"))
                      for k in range(1, 13)])
    acs = nk.select(F.col("fips").alias("GEOID"),
                    F.concat("n_name", F.lit(" County, "), "r_name").alias("NAME"),
                    F.explode(cells).alias("c")).select(
        "GEOID", "NAME", F.col("c.variable").alias("variable"), F.col("c.estimate").alias("estimate"),
        F.lit(0.0).alias("moe"))
    return {"nyt": nyt, "orders": orders, "pop": pop, "area": area, "acs": acs}


def _cases(spark, d):
    from plume.sources.health import cases
    t = nation_cases_inputs(spark, d)
    return cases(spark, t["nyt"], t["orders"], t["pop"], t["area"], t["acs"],
                 start=ORDER_SPINE[0], end=ORDER_SPINE[1])


def cases_daily_build(spark, d):
    x = _cases(spark, d)["daily"]
    return x.select("county_fips", "date", "state", "county", "popestimate2019",
                    F.col("cases").cast("long"), F.col("deaths").cast("long"),
                    *[r6(c).alias(c) for c in ["share_over_65", "km_sq", "log_cases",
                                               "log_deaths", "log_pop_density"]])


def cases_weekly_build(spark, d):
    x = _cases(spark, d)["weekly"]
    return x.select("county_fips", "state", "county", "week_start_date",
                    *[r6(c).alias(c) for c in ["share_over_65", "log_pop_density", "mean_cases",
                                               "mean_deaths", "log_cases", "log_deaths"]])


# --- the distancing panel build (D11) on one nation x 1998 world -------------------

PANEL_DAYS = ("1998-01-25", "1998-05-31")   # 127 days; the first (a Sunday) is dropped weekly


def nation_world(spark, d) -> dict:
    """Raw tables of every source at nation grain (county = nation, state =
    region), all derived from the driver tables, so the panel's joins line up."""
    keys = _nation_keys(spark, d)
    cust = table(spark, d, "customer")
    cn = cust.join(keys, cust.c_nationkey == keys.n_nationkey)
    o = table(spark, d, "orders").select("o_custkey", fold_day(F.to_date("o_orderdate")).alias("day"))
    # each customer's orders per day of the spine as one map (<= 126 entries),
    # joined at customer grain; the day rows are generated after the join, so
    # the expanded rows never cross a shuffle
    per_c = o.groupBy("o_custkey", "day").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.map_from_entries(F.collect_list(F.struct("day", "n"))).alias("orders_by_day"))
    base_rows = cn.select("c_custkey", "fips", "c_acctbal").join(per_c, "c_custkey", "left")
    # 127 days grow from each row, so the rows are dealt out first: the tasks would
    # else be as few as the splits of the small customer file
    spread = base_rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    dev = shape.date_spine(spread, *PANEL_DAYS, "day", distinct=False)
    n_o = F.coalesce(F.try_element_at("orders_by_day", F.col("day")), F.lit(0))
    devices = dev.select(
        F.concat("fips", F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("origin_census_block_group"),
        F.concat(F.col("day").cast("string"), F.lit("T00:00:00-05:00")).alias("date_range_start"),
        (F.lit(50) + n_o * 10 + F.dayofweek("day")).cast("long").alias("device_count"),
        (F.lit(20) + F.floor(F.abs("c_acctbal") / 2000)
         + F.when(F.dayofmonth("day") > 15, 1).otherwise(0)).cast("long")
        .alias("completely_home_device_count"),
        (F.abs("c_acctbal") / 10 + n_o).alias("median_home_dwell_time"),
        (F.abs("c_acctbal") / 20 + F.dayofweek("day")).alias("median_non_home_dwell_time"),
        (F.lit(60) + n_o * 10 + F.dayofweek("day")).cast("long").alias("candidate_device_count"))
    # weather: per nation and ship day from line items
    li = table(spark, d, "lineitem").select("l_orderkey", "l_discount", "l_tax", "l_quantity",
                                            fold_day(F.to_date("l_shipdate")).alias("day"))
    # orders meet their nation first, so line items cross one shuffle only
    oc = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey") \
        .join(cust.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey") \
        .join(keys, F.col("c_nationkey") == keys.n_nationkey).select("l_orderkey", "fips")
    lw = li.join(oc, "l_orderkey")
    weather = lw.groupBy("fips", "day").agg(
        (rsem.exact_mean("l_discount") * 100).alias("precip"), (F.min("l_tax") * 100).alias("tmin"),
        F.max("l_quantity").alias("tmax")).select(
        F.col("fips").cast("int").cast("string").alias("county"),
        F.col("day").cast("string").alias("date"), "precip", "tmin", "tmax")
    # census: long ACS cells from customer counts by segment
    seg = lambda v: F.count(F.when(F.col("c_mktsegment") == v, 1)).cast("double")
    pc = cn.groupBy("fips", "n_name", "r_name").agg(
        F.count(F.lit(1)).cast("double").alias("total"),
        seg("BUILDING").alias("bachelors"), seg("AUTOMOBILE").alias("white"),
        seg("FURNITURE").alias("black"), seg("HOUSEHOLD").alias("asian"),
        seg("MACHINERY").alias("current_undergrad"),
        F.count(F.when(F.col("c_acctbal") < 0, 1)).cast("double").alias("poverty"),
        F.count(F.when(F.col("c_acctbal") > 9000, 1)).cast("double").alias("hhinc_100k"),
        F.count(F.when(F.col("c_acctbal") > 0, 1)).cast("double").alias("total_occupations"),
        F.count(F.when(F.col("c_acctbal") > 5000, 1)).cast("double").alias("msta"),
        F.count(F.when(F.col("c_acctbal").between(0, 2000), 1)).cast("double").alias("services"),
        F.count(F.when(F.col("c_acctbal").between(2000, 4000), 1)).cast("double").alias("sales"),
        F.count(F.when(F.col("c_acctbal").between(4000, 5000), 1)).cast("double").alias("resources"),
        F.count(F.when(F.col("c_acctbal") > 8000, 1)).cast("double").alias("public_transit"))
    from plume.sources.context import ACS_OCC_VARS, ACS_REP_VARS
    names = ACS_REP_VARS + [v for v in ACS_OCC_VARS]
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("estimate")) for v in names])
    acs = pc.select(F.col("fips").alias("GEOID"),
                    F.concat("n_name", F.lit(" County, "), "r_name").alias("NAME"),
                    F.explode(cells).alias("c")).select(
        "GEOID", "NAME", "c.variable", "c.estimate", F.lit(0.0).alias("moe"))
    pop16 = pc.select(F.concat(F.lit("."), "n_name", F.lit(" County, "), "r_name").alias("county"),
                      F.col("total").cast("long").alias("population"))
    # votes: one precinct per customer
    votes = cn.select(F.col("r_name").alias("state"), F.substring("fips", 1, 2).alias("state_fips"),
                      F.lit("XX").alias("state_postal"), F.col("n_name").alias("county_name"),
                      F.col("fips").alias("county_fips"), F.lit(0.0).alias("county_lat"),
                      F.lit(0.0).alias("county_long"), F.lit("US President").alias("office"),
                      F.lit("c").alias("candidate"), F.lit("p").alias("party"),
                      F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "trump")
                      .otherwise("other").alias("candidate_normalized"),
                      F.floor(F.abs("c_acctbal")).cast("long").alias("votes"))
    # orders at nation grain: region-wide and nation-wide 1-URGENT spells
    ou = table(spark, d, "orders") \
        .select("o_custkey", "o_orderpriority", "o_totalprice", fold_day(F.to_date("o_orderdate")).alias("od")) \
        .join(cust.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey") \
        .join(keys, F.col("c_nationkey") == keys.n_nationkey)
    reg = ou.groupBy("r_name").agg(
        _dearest_in(3).alias("ss"), _dearest_in(4).alias("se"))
    nat = ou.groupBy("fips").agg(_dearest_in(2).alias("cs"), _dearest_in(5).alias("ce"))
    fmt = lambda c: F.date_format(c, "M/d/yyyy")
    ko = keys.join(reg, "r_name", "left").join(nat, "fips", "left")
    none = F.lit(None).cast("string")
    county_orders = ko.select(
        F.substring("fips", 1, 2).alias("state_code"), F.substring("fips", 3, 3).alias("county_code"),
        F.lit("XX").alias("state"), F.col("r_name").alias("state_name"),
        F.concat("n_name", F.lit(" County")).alias("county_name"), F.lit(1000).cast("long")
        .alias("popestimate2019"),
        fmt("ss").alias("state_sip_start_date"), fmt("se").alias("state_sip_end_date"),
        fmt("cs").alias("county_sip_start_date"), fmt("ce").alias("county_sip_end_date"),
        *[none.alias(f"citation{i}") for i in range(1, 6)])
    return {"devices": devices, "weather": weather, "acs": acs, "pop16": pop16, "votes": votes,
            "county_orders": county_orders}


def _panel_sources(spark, d) -> dict:
    """The cleaned sources of the panels, each from its own stage.

    The order dates (one row per nation) are written once: the order stage reads
    its county table twice, and each reading is a pass over all orders."""
    from plume.sources import context, health, mobility
    w = nation_world(spark, d)
    dist = mobility.distancing(w["devices"], n_days=127, base=("1998-01-26", "1998-02-01"),
                               last_day=PANEL_DAYS[1], first_week="1998-01-26")
    county_orders = w["county_orders"].checkpoint()
    pop = county_orders.select(F.col("state_code").alias("STATE"),
                               F.col("county_code").alias("COUNTY"),
                               F.col("state_name").alias("STNAME"),
                               F.col("county_name").alias("CTYNAME"),
                               F.col("popestimate2019").alias("POPESTIMATE2019"))
    cin = nation_cases_inputs(spark, d)
    return {"dist": dist, "census": context.census(w["acs"], w["pop16"]),
            "weather": context.weather(w["weather"], first_week="1998-01-26"),
            "orders": health.orders(county_orders, pop, "1998-01-26", PANEL_DAYS[1]),
            "cases": health.cases(spark, cin["nyt"], cin["orders"], cin["pop"], cin["area"], cin["acs"],
                                  start="1998-01-26", end=PANEL_DAYS[1]),
            "votes": context.votes(w["votes"])}


def panel_distancing_build(spark, d):
    """Distancing-only county-week panel built from every source stage."""
    from plume.plans.build import panel_distancing_weekly
    x = _panel_sources(spark, d)
    panel = panel_distancing_weekly(x["dist"]["weekly"], x["census"], x["weather"]["weekly"],
                                    x["orders"]["weekly"], x["cases"]["weekly"], x["votes"])
    kinds = dict(panel.dtypes)
    return panel.select(*[r6(c).alias(c) if kinds[c] == "double"
                          else F.col(c).cast("long") if kinds[c] in ("int", "bigint")
                          else F.col(c) for c in panel.columns])


# --- incremental roll-up (survey 2.14) over device files derived from events -------

def streaming_device_rollup(spark, d):
    """The events-derived device rows arrive as CSV files in a folder under the
    shared checkpoint folder (first and second half of the month as separate
    writes); the file-source stream rolls them up trigger by trigger
    (``availableNow``, one file per trigger) and the silver table is read back."""
    import uuid

    from plume.session import scratch_path
    from plume.streaming.incremental import _rollup_stream, _device_rollup, _device_rows
    from plume.sources import schemas as sch

    base = scratch_path(spark, "streams", f"devices-{uuid.uuid4().hex}")
    dev = device_days(spark, d)
    first = F.substring("date_range_start", 1, 10) < "2024-01-16"
    dev.filter(first).write.option("header", True).csv(f"{base}/src")
    dev.filter(~first).write.mode("append").option("header", True).csv(f"{base}/src")
    q = _rollup_stream(spark, f"{base}/src", sch.DEVICE_DAILY, f"{base}/bronze", f"{base}/silver",
                       "date", _device_rows, _device_rollup, f"{base}/ck", max_files=1)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/silver")
    return out.select("county_fips", F.col("date").cast("date").alias("date"), "device_count",
                      "completely_home_device_count",
                      *[r6(c).alias(c) for c in ["share_of_devices", "share_of_candidate_devices",
                                                 "median_home_dwell_time",
                                                 "median_non_home_dwell_time"]])


# --- the full weekly panel (D10): POI outcomes + the D11 chain ----------------------

def supplier_patterns(spark, d) -> dict:
    """Stand-in POI inputs at nation grain: place = supplier, visits = line
    items it ships per day (folded into the spine), visitors = active days, home
    map by the rule of ``weekly_patterns`` on the shipped quantity; the place
    lookup and the county-name -> FIPS table come from nation and region."""
    keys = _nation_keys(spark, d)
    sup = table(spark, d, "supplier").join(keys, F.col("s_nationkey") == keys.n_nationkey)
    li = table(spark, d, "lineitem").select("l_suppkey", "l_quantity",
                                            fold_day(F.to_date("l_shipdate")).alias("day"))
    li = li.withColumn("week", cal.week_start("day"))
    per_day = li.groupBy("l_suppkey", "week", "day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    pw = per_day.groupBy("l_suppkey", "week").agg(
        F.map_from_entries(F.collect_list(F.struct(F.datediff("day", "week"), "n"))).alias("m"),
        F.sum("n").alias("raw_visit_counts"), F.count(F.lit(1)).alias("raw_visitor_counts"),
        F.sum("q").cast("long").alias("sq"))
    days = F.transform(F.sequence(F.lit(0), F.lit(6)),
                       lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)).cast("string"))
    cbg = F.lpad(F.col("l_suppkey").cast("string"), 12, "0")
    homes = F.when(F.col("sq") % 5 == 0, F.lit("{}")) \
        .when(F.col("sq") % 2 == 0, F.concat(F.lit('{"'), cbg, F.lit('": '),
                                             (F.col("sq") % 9).cast("string"),
                                             F.lit(', "999999999999": 1}'))) \
        .otherwise(F.concat(F.lit('{"888888888888": 3, "'), cbg, F.lit('": 2}')))
    patterns = pw.select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("safegraph_place_id"),
        F.concat(F.col("week").cast("string"), F.lit("T00:00:00-05:00")).alias("date_range_start"),
        F.concat(F.lit("["), F.array_join(days, ","), F.lit("]")).alias("visits_by_day"),
        "raw_visit_counts", "raw_visitor_counts", cbg.alias("poi_cbg"),
        homes.alias("visitor_home_cbgs"))
    lookup = sup.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("safegraph_place_id"),
                        F.lit("441110").alias("naics_code"), F.lower("r_name").alias("state"),
                        F.lower("n_name").alias("county"))
    fips = keys.select(F.lower("r_name").alias("state"), F.lower("n_name").alias("county"),
                       F.col("fips").alias("county_fips"))
    return {"patterns": patterns, "lookup": lookup, "county_fips": fips}


def panel_weekly_build(spark, d):
    """The 47-column county-week panel from every source stage."""
    panel = _panel_weekly(spark, d)
    kinds = dict(panel.dtypes)
    return panel.select(*[r6(c).alias(c) if kinds[c] == "double"
                          else F.col(c).cast("long") if kinds[c] in ("int", "bigint")
                          else F.col(c) for c in panel.columns])


def map_deciles_report(spark, d):
    """POI visits relative to event week -8 and their global decile."""
    from plume.plans.report import map_deciles
    dec = map_deciles(_panel_weekly(spark, d), "weeks_since_start", -8, "total_visits")
    return dec.select("county_fips", "state", "week_start_date",
                      F.col("weeks_since_start").cast("long"), F.col("total_visits").cast("long"),
                      r6("adj_visits").alias("adj_visits"), F.col("decile").cast("long"))


def map_week_report(spark, d):
    """The map of one event week."""
    from plume.plans.report import map_deciles, map_week
    dec = map_deciles(_panel_weekly(spark, d), "weeks_since_start", -8, "total_visits")
    out = map_week(dec, "weeks_since_start", 0)
    return out.select("region", F.col("value").cast("long"))


def partisan_trends_report(spark, d):
    """Outcome means by above/below-median vote share, relative to the
    first week."""
    from plume.plans.report import OUTCOMES, partisan_trends
    tr = partisan_trends(_panel_weekly(spark, d), base="1998-01-26")
    return tr.select(F.col("republican").cast("long"), "week_start_date",
                     *[r6(c).alias(c) for c in OUTCOMES],
                     *[r6(f"{c}_adj").alias(f"{c}_adj") for c in OUTCOMES])


def event_study_report(spark, d):
    """The six-model event-study sweep on the full panel, lags and leads
    included; its oracle solves the same six models in SQL."""
    from plume.plans.report import event_study
    return _rounded_table(event_study(spark, _panel_weekly(spark, d)))


def _panel_weekly(spark, d):
    """The D10 panel, written once per application (see ``common.materialized``)."""
    from plume.plans.common import materialized
    inputs = {t: table(spark, d, t) for t in
              ("region", "nation", "customer", "supplier", "orders", "lineitem")}
    return materialized(spark, "panel_weekly", inputs, lambda: _build_panel_weekly(spark, d))


def _build_panel_weekly(spark, d):
    from plume.plans.build import panel_weekly
    from plume.sources import mobility
    sp = supplier_patterns(spark, d)
    poi = mobility.poi_weekly_outcomes(
        mobility.poi_patterns(sp["patterns"], sp["lookup"])["weekly"], sp["county_fips"])
    x = _panel_sources(spark, d)
    return panel_weekly(poi, x["dist"]["weekly"], x["census"], x["weather"]["weekly"],
                        x["orders"]["weekly"], x["cases"]["weekly"], x["votes"])


def panel_daily_build(spark, d):
    """The county-day panel from every daily source stage."""
    from plume.plans.build import panel_daily
    x = _panel_sources(spark, d)
    panel = panel_daily(x["dist"]["daily"], x["census"], x["weather"]["daily"], x["orders"]["daily"],
                        x["cases"]["daily"], x["votes"], state="america")["daily"]
    kinds = dict(panel.dtypes)
    return panel.select(*[r6(c).alias(c) if kinds[c] == "double"
                          else F.col(c).cast("long") if kinds[c] in ("int", "bigint")
                          else F.col(c) for c in panel.columns])


def votes_attributes_build(spark, d):
    """County vote shares joined to the county attribute table (J3),
    both at nation grain, state "02" dropped on both sides."""
    from plume.plans.build import votes_with_attributes
    from plume.sources import context
    votes = context.votes(nation_world(spark, d)["votes"])
    keys = _nation_keys(spark, d)
    attrs = keys.select(F.col("fips").alias("GEOID10"),
                        F.substring("fips", 1, 2).alias("STATEFP10"))
    out = votes_with_attributes(votes, attrs)
    return out.select("county_fips", "state", "state_fips", "county_name", "STATEFP10",
                      r6("trump_vote_share").alias("trump_vote_share"))


def state_order_dates_report(spark, d):
    """The distinct order dates of one state's counties (state = nation 3)."""
    from plume.sources.health import state_order_dates
    x = state_order_dates(_orders_build(spark, d)["daily"], "nation_3")
    return x


def snapshot_latest(spark, d):
    from plume.sources.io import read_latest, write_snapshot
    from plume.session import scratch_path
    import uuid
    base = scratch_path(spark, "snapshots", f"nation-{uuid.uuid4().hex}")
    write_snapshot(table(spark, d, "nation"), base, as_of="2024-01-31")
    return read_latest(spark, base)
