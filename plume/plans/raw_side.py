"""Driver queries of the raw side: inferred and checked scans, rejected lines,
one-parse outputs, versioned snapshots, the POI lookup and interval joins, with
their DuckDB oracles.  Files are written from the driver tables into the shared
scratch folder first, so every query's work grows with the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.operators import aggregate as agg
from plume.operators import intervals, joins, shape
from plume.plans import standins as s
from plume.plans.common import r6, table
from plume.plans.oracle import PLACE_WEEKS, R6
from plume.session import scratch_path
from plume.sources import infer, io


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "raw", f"{name}-{uuid.uuid4().hex}")


# --- S1-S4: scans of text files ---------------------------------------------------

def _order_lines(spark, d) -> DataFrame:
    """Orders as text columns: a code with leading zeros, a number with blanks,
    a day, a flag, an amount."""
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("code"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "NA").otherwise(F.substring("o_orderpriority", 1, 1)).alias("priority"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(F.col("o_orderstatus") == "F", "TRUE").otherwise("FALSE").alias("closed"),
        F.col("o_totalprice").cast("string").alias("total"), "o_orderpriority")


def inferred_csv_scan(spark, d):
    """Types found in the file, values typed by them."""
    path = _folder(spark, "inferred")
    io.to_csv(_order_lines(spark, d), path)
    got = infer.read_inferred(spark, path)
    types = ",".join(f"{c}:{t}" for c, t in got.dtypes)
    return got.withColumn("total", r6(F.col("total") * 1.0)).withColumn("types", F.lit(types))


_INFERRED = """
  SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS code,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS priority,
         CAST(o_orderdate AS DATE) AS day, o_orderstatus = 'F' AS closed, floor(o_totalprice * 1e6 + 0.5) / 1e6 AS total,
         o_orderpriority,
         'o_orderkey:bigint,code:string,priority:bigint,day:date,closed:boolean,total:double,o_orderpriority:string' AS types
  FROM orders"""


def _event_lines(spark, d) -> DataFrame:
    """Events as comma-separated lines; the value of an error event is no number,
    and a signup of an even user lacks its last field."""
    ev = table(spark, d, "events")
    value = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("event_id").cast("string"))
    short = (F.col("event_type") == "signup") & (F.col("user_id") % 2 == 0)
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), value,
                       F.when(~short, F.col("event_type")))
    return ev.select("event_type", line.alias("line"))


_EVENT_LINE = """CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || ','
    || CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(event_id AS VARCHAR) END
    || CASE WHEN event_type = 'signup' AND user_id % 2 = 0 THEN '' ELSE ',' || event_type END"""


def checked_gz_directory(spark, d):
    """A directory tree of gzip files under one schema; lines that do not
    fit are kept apart and counted in the same pass."""
    path = _folder(spark, "events")
    _event_lines(spark, d).write.partitionBy("event_type").option("compression", "gzip").text(path)
    checked = io.read_csv_checked(spark, path, "event_id bigint, user_id bigint, value bigint, event_type string",
                                  recursiveFileLookup=True, pathGlobFilter="*.gz")
    good, rejects, counts = io.split_rejects(checked, _folder(spark, "split"))
    out = good.withColumn("line", F.lit(None).cast("string")).unionByName(
        rejects.select("line"), allowMissingColumns=True)
    return out.withColumn("rows_seen", F.lit(counts["rows"])).withColumn("rows_rejected", F.lit(counts["rejected"]))


_CHECKED = f"""
  WITH x AS (SELECT *, event_type = 'error' OR (event_type = 'signup' AND user_id % 2 = 0) AS bad, {_EVENT_LINE} AS line
             FROM events),
  n AS (SELECT COUNT(*) AS rows_seen, COUNT(*) FILTER (WHERE bad) AS rows_rejected FROM x)
  SELECT CASE WHEN NOT bad THEN event_id END AS event_id, CASE WHEN NOT bad THEN user_id END AS user_id,
         CASE WHEN NOT bad THEN event_id END AS value, CASE WHEN NOT bad THEN event_type END AS event_type,
         CASE WHEN bad THEN line END AS line, rows_seen, rows_rejected
  FROM x, n"""


# --- S10: versions ---------------------------------------------------------------------

def snapshot_versions(spark, d):
    """Two dates, the first written twice; each read follows the pointer."""
    base = _folder(spark, "snapshot")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    io.write_snapshot(o.filter("status = 'O'"), base, "2024-01-30")
    io.write_snapshot(o.filter("status = 'F'"), base, "2024-01-30")
    io.write_snapshot(o, base, "2024-01-31")
    return shape.union_all([io.read_latest(spark, base).withColumn("read", F.lit("latest")),
                            io.read_snapshot(spark, base, "2024-01-30").withColumn("read", F.lit("dated"))])


_SNAPSHOTS = """
  SELECT o_orderkey, o_orderstatus AS status, DATE '2024-01-31' AS snapshot_date, 'latest' AS read FROM orders
  UNION ALL
  SELECT o_orderkey, o_orderstatus, DATE '2024-01-30', 'dated' FROM orders WHERE o_orderstatus = 'F'"""


# --- S11: four outputs, one parse ----------------------------------------------------------

def poi_outputs_build(spark, d):
    """Weekly and daily visits by county and by county and NAICS, from
    one scan, written by one job and read back."""
    from plume.sources.mobility import poi_patterns_stacked
    base = _folder(spark, "poi")
    io.write_stacked(poi_patterns_stacked(s.weekly_patterns(spark, d), s.poi_lookup(spark, d)), base)
    cols = ["state", "county", "naics", "date", "total_visits", "total_visitors", "total_visitors_same_cbg",
            "total_visitors_diff_cbg"]
    return shape.union_all([io.read_stacked(spark, base, k, cols).withColumn("output", F.lit(k))
                            for k in ("weekly", "weekly_naics", "daily", "daily_naics")])


_POI_OUTPUTS = PLACE_WEEKS + """,
  pd AS (SELECT pw.user_id, pw.code, CAST(pw.week + INTERVAL (r.i) DAY AS DATE) AS date
         FROM pw CROSS JOIN range(0, 7) r(i)),
  dn AS (SELECT user_id, code, day AS date, COUNT(*) AS n FROM ev GROUP BY 1, 2, 3),
  dd AS (SELECT state, county, naics, pd.date, CAST(sum(coalesce(dn.n, 0)) AS BIGINT) AS total_visits
         FROM pd LEFT JOIN dn USING (user_id, code, date) JOIN lk USING (user_id, code) GROUP BY 1, 2, 3, 4),
  ww AS (SELECT state, county, naics, week AS date, CAST(sum(visits) AS BIGINT) AS total_visits,
                CAST(sum(visitors) AS BIGINT) AS total_visitors, CAST(sum(same) AS BIGINT) AS total_visitors_same_cbg,
                CAST(sum(visitors - same) AS BIGINT) AS total_visitors_diff_cbg
         FROM sp JOIN lk USING (user_id, code) GROUP BY 1, 2, 3, 4)
  SELECT 'weekly_naics' AS output, * FROM ww
  UNION ALL
  SELECT 'weekly', state, county, NULL, date, CAST(sum(total_visits) AS BIGINT), CAST(sum(total_visitors) AS BIGINT),
         CAST(sum(total_visitors_same_cbg) AS BIGINT), CAST(sum(total_visitors_diff_cbg) AS BIGINT)
  FROM ww GROUP BY state, county, date
  UNION ALL
  SELECT 'daily_naics', state, county, naics, date, total_visits, NULL, NULL, NULL FROM dd
  UNION ALL
  SELECT 'daily', state, county, NULL, date, CAST(sum(total_visits) AS BIGINT), NULL, NULL, NULL
  FROM dd GROUP BY state, county, date"""


# --- D1: POI to county ------------------------------------------------------------------------

#: fixed county outlines: (state, county, [rings]); the last has a hole
COUNTIES = [
    ("t1", "tri", [[(0.0, 0.0), (30.0, 0.0), (0.0, 60.0)]]),
    ("t1", "pent", [[(30.0, 10.0), (60.0, 10.0), (75.0, 45.0), (50.0, 90.0), (20.0, 60.0)]]),
    ("t2", None, [[(60.0, 50.0), (95.0, 60.0), (90.0, 99.0), (65.0, 85.0)]]),
    ("t2", "ring", [[(0.0, 100.0), (100.0, 100.0), (100.0, 250.0), (0.0, 250.0)],
                    [(20.0, 120.0), (20.0, 200.0), (80.0, 200.0), (80.0, 120.0)]]),
]


def _outlines(spark) -> DataFrame:
    rows = [(a, b, r, i, x, y) for a, b, rings in COUNTIES for r, ring in enumerate(rings)
            for i, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, "state string, county string, ring int, seq int, lon double, lat double")


def poi_counties_build(spark, d):
    """Every event as a point of interest, looked up in outlines with a
    hole, a crossing pair and a county without a name."""
    from plume.sources.mobility import poi_counties
    ev = table(spark, d, "events")
    core = ev.select(
        F.col("event_id").cast("string").alias("safegraph_place_id"), s._type_code().cast("string").alias("naics_code"),
        (F.col("user_id") % 100).cast("double").alias("longitude"), F.col("value").alias("latitude"))
    return poi_counties(core, _outlines(spark), cell=10.0)


def null_county_share(spark, d):
    """D1's check: the share of points in no state."""
    from plume.sources.mobility import null_county_share as share
    poi = poi_counties_build(spark, d).withColumn("county", F.col("state"))
    return share(poi).select(r6("null_county_share").alias("null_county_share"), "n_poi")


def _inside_sql() -> str:
    edges = ", ".join(f"('{a}', {'NULL' if b is None else repr(b)}, {k}, {x1}, {y1}, {x2}, {y2})"
                      for k, (a, b, rings) in enumerate(COUNTIES) for ring in rings
                      for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]))
    code = " ".join(f"WHEN '{t}' THEN '{k}'" for k, t in enumerate(
        ["click", "error", "purchase", "signup", "view"], 1))
    return f"""
  WITH p AS (SELECT CAST(event_id AS VARCHAR) AS safegraph_place_id, CASE event_type {code} ELSE '0' END AS naics_code,
                    CAST(user_id % 100 AS DOUBLE) AS longitude, value AS latitude FROM events),
  e AS (SELECT * FROM (VALUES {edges}) t(state, county, k, x1, y1, x2, y2)),
  hit AS (SELECT safegraph_place_id, k, state, county FROM p CROSS JOIN e GROUP BY 1, 2, 3, 4
          HAVING bool_or((longitude - x1) * (y2 - y1) = (latitude - y1) * (x2 - x1)
                         AND longitude BETWEEN least(x1, x2) AND greatest(x1, x2)
                         AND latitude BETWEEN least(y1, y2) AND greatest(y1, y2))
              OR sum(CASE WHEN (y1 > latitude) <> (y2 > latitude)
                           AND longitude < (x2 - x1) * (latitude - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1),
  first AS (SELECT *, row_number() OVER (PARTITION BY safegraph_place_id ORDER BY state, county NULLS FIRST) AS r FROM hit)
  SELECT p.*, f.state, f.county FROM p LEFT JOIN first f ON f.safegraph_place_id = p.safegraph_place_id AND r = 1"""


# --- J8: interval joins ----------------------------------------------------------------------

def orders_in_force_at_events(spark, d):
    """Whether the state's order holds on each event's day, open starts
    and ends included, without a spine of states x days."""
    ev = table(spark, d, "events").select(
        "event_id", F.floor(F.col("user_id") / 10).cast("long").alias("state_id"), F.to_date("ts").alias("day"),
        "event_type", "value")
    dates = ev.groupBy("state_id").agg(
        F.min(F.when((F.col("event_type") == "signup") & (F.col("value") > 150), F.col("day"))).alias("first_day"),
        F.max(F.when((F.col("event_type") == "error") & (F.col("value") > 250), F.col("day"))).alias("last_day"))
    return intervals.times_in_force(ev.select("event_id", "state_id", "day"), dates, "day", "first_day", "last_day",
                                    ["state_id"])


_IN_FORCE = """
  WITH ev AS (SELECT event_id, user_id // 10 AS state_id, CAST(ts AS DATE) AS day, event_type, value FROM events),
  st AS (SELECT state_id, min(CASE WHEN event_type = 'signup' AND value > 150 THEN day END) AS a,
                max(CASE WHEN event_type = 'error' AND value > 250 THEN day END) AS b FROM ev GROUP BY 1)
  SELECT event_id, state_id, day,
         CAST(CASE WHEN (a IS NOT NULL OR b IS NOT NULL)
                    AND day BETWEEN coalesce(a, DATE '1000-01-01') AND coalesce(b, DATE '9999-01-01') THEN 1 ELSE 0 END AS BIGINT)
           AS in_force
  FROM ev LEFT JOIN st USING (state_id)"""


def open_orders_at_shipments(spark, d):
    """J8 with many overlapping intervals: on each ship day of a nation, its
    customers' orders that were open (ordered, not all shipped yet)."""
    li = table(spark, d, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("ship_day"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
                                         F.to_date("o_orderdate").alias("order_day"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    placed = o.join(c, "o_custkey")
    # one row per (nation, first day, last day), with its orders; both sides are
    # written, as the interval join reads them more than once
    spans = li.groupBy("l_orderkey").agg(F.max("ship_day").alias("last_day")).join(placed, "l_orderkey") \
        .groupBy("c_nationkey", "l_orderkey").agg(F.min("order_day").alias("first_day"), F.max("last_day").alias("last_day")) \
        .groupBy("c_nationkey", "first_day", "last_day").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    days = li.join(placed, "l_orderkey").select("c_nationkey", "ship_day").distinct().checkpoint()
    return intervals.range_join(days, spans, "ship_day", "first_day", "last_day", ["c_nationkey"], sums=["n"]) \
        .groupBy("c_nationkey", "ship_day").agg(F.sum("n").alias("open_orders"))


_OPEN_ORDERS = """
  WITH r AS (SELECT c_nationkey, l_orderkey, CAST(l_shipdate AS DATE) AS ship_day, CAST(o_orderdate AS DATE) AS order_day
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
  sp AS (SELECT c_nationkey, a, b, COUNT(*) AS n FROM (SELECT c_nationkey, l_orderkey, min(order_day) AS a, max(ship_day) AS b
         FROM r GROUP BY 1, 2) x GROUP BY 1, 2, 3),
  dy AS (SELECT DISTINCT c_nationkey, ship_day FROM r)
  SELECT dy.c_nationkey, ship_day, CAST(sum(n) AS BIGINT) AS open_orders
  FROM dy JOIN sp ON sp.c_nationkey = dy.c_nationkey AND ship_day BETWEEN a AND b GROUP BY 1, 2"""


# --- J5, P3, P4, O1, O2, H12, D15 ---------------------------------------------------------------

def full_coverage_anti(spark, d):
    """Entities without full coverage leave by an anti join."""
    daily = s._daily(spark, d)
    n_days = daily.agg(F.countDistinct("day")).first()[0]
    return agg.full_coverage(daily, ["user_id"], "day", n_days).select("user_id", "day", "n_events")


def unmatched_customers(spark, d):
    """Customers without an order."""
    c = table(spark, d, "customer")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(c, o, ["c_custkey"]).select("c_custkey", "c_name", "c_nationkey")


def wide_table_page(spark, d):
    """The notebooks' look at a wide table: sorted, some columns by
    name range and by position, the first ten rows (the limit is the feature)."""
    o = table(spark, d, "orders")
    page = o.select(*shape.cols_between(o, "o_orderkey", "o_totalprice"))
    return shape.preview(shape.arrange(page, "o_totalprice", "o_orderkey"), 1, 4, 10)


def event_study_band(spark, d):
    """The event-study table between two event weeks, the same in every
    model whatever its base."""
    panel = s._weekly_event_panel(spark, d).withColumn("n_days", F.col("n_days").cast("double"))
    specs = [s.es.Spec(f"{side}_{kind}", "log_total_value", f"weeks_since_{side}", controls)
             for side in ("start", "end") for kind, controls in (("plain", []), ("controls", ["n_days"]))]
    return s._rounded_table(s.es.sweep(spark, panel, specs, "user_id", weeks=(-2, 2)))


def partisan_cases_long_report(spark, d):
    """Total cases and deaths by vote group and week, long."""
    from plume.plans.report import partisan_cases_long
    out = partisan_cases_long(s._panel_weekly(spark, d))
    return out.select(F.col("republican").cast("long"), "week_start_date", "measure", r6("count").alias("count"))


def streaming_coverage(spark, d):
    """2.14 with state (M8, M1): device files arrive later half first; the days
    seen and the base-week mean of each county are kept by the stream."""
    from plume.streaming.coverage import coverage_stream, read_coverage
    base = _folder(spark, "coverage")
    dev = s.device_days(spark, d)
    first = F.substring("date_range_start", 1, 10) < "2024-01-16"
    dev.filter(~first).coalesce(2).write.option("header", True).csv(f"{base}/src")
    coverage_stream(spark, f"{base}/src", f"{base}/out", (s.STUDY_START, "2024-01-07"), f"{base}/ck", 1).awaitTermination()
    dev.filter(first).coalesce(2).write.mode("append").option("header", True).csv(f"{base}/src")
    coverage_stream(spark, f"{base}/src", f"{base}/out", (s.STUDY_START, "2024-01-07"), f"{base}/ck", 1).awaitTermination()
    return read_coverage(spark, f"{base}/out").select(
        "county_fips", "n_days", r6("initial_device_count").alias("initial_device_count"))


_COVERAGE = f"""
  WITH dv AS (SELECT lpad(CAST(user_id AS VARCHAR), 5, '0') AS county_fips, CAST(ts AS DATE) AS date, COUNT(*) AS devices
              FROM events GROUP BY user_id, event_type, CAST(ts AS DATE))
  SELECT county_fips, count(DISTINCT date) AS n_days,
         {R6("avg(devices) FILTER (WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-07')")} AS initial_device_count
  FROM dv GROUP BY 1"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    inferred_csv_scan, checked_gz_directory, snapshot_versions, poi_outputs_build, poi_counties_build, null_county_share,
    orders_in_force_at_events, open_orders_at_shipments, full_coverage_anti, unmatched_customers, wide_table_page,
    event_study_band, partisan_cases_long_report, streaming_coverage)}


def oracles(known: dict[str, str]) -> dict[str, str]:
    """``known``: the oracles of the other queries, on which two of these build."""
    panel = known["partisan_trends_report"].split(", med AS (")[0]
    return {
        "inferred_csv_scan": _INFERRED, "checked_gz_directory": _CHECKED, "snapshot_versions": _SNAPSHOTS,
        "poi_outputs_build": _POI_OUTPUTS, "poi_counties_build": _inside_sql(),
        "null_county_share": f"""SELECT {R6('avg(CASE WHEN state IS NULL THEN 1.0 ELSE 0.0 END)')} AS null_county_share,
                                        COUNT(*) AS n_poi FROM ({_inside_sql()}) x""",
        "streaming_coverage": _COVERAGE,
        "orders_in_force_at_events": _IN_FORCE, "open_orders_at_shipments": _OPEN_ORDERS,
        "full_coverage_anti": known["coverage_filter"],
        "unmatched_customers": """SELECT c_custkey, c_name, c_nationkey FROM customer
                                  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)""",
        "wide_table_page": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
                              ORDER BY o_totalprice NULLS LAST, o_orderkey NULLS LAST LIMIT 10""",
        "event_study_band": f"""SELECT * FROM ({known['event_study_table']}) t
            WHERE TRY_CAST(regexp_extract(term, '^weeks_since_(start|end)(-?[0-9]+)$', 2) AS BIGINT) BETWEEN -2 AND 2""",
        "partisan_cases_long_report": panel + f""", med AS (SELECT quantile_cont(trump_vote_share, 0.5) AS m FROM f),
  g AS (SELECT CASE WHEN trump_vote_share > m THEN 1 WHEN trump_vote_share <= m THEN 0 END AS republican, week_start_date,
               coalesce(CAST(sum(CAST(floor((exp(log_cases) - 1) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9, 0) AS total_cases,
               coalesce(CAST(sum(CAST(floor((exp(log_deaths) - 1) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9, 0) AS total_deaths
        FROM f, med GROUP BY 1, 2)
  SELECT CAST(republican AS BIGINT) AS republican, week_start_date, 'total_cases' AS measure, {R6('total_cases')} AS count FROM g
  UNION ALL SELECT CAST(republican AS BIGINT), week_start_date, 'total_deaths', {R6('total_deaths')} FROM g""",
    }


