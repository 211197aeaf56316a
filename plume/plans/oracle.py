"""DuckDB oracle SQL for the driver queries (same keys and column names).

``R6(x)`` = ``floor(x * 1e6 + 0.5) / 1e6``, the same arithmetic as
``plume.plans.common.r6``.

Sums and means of double columns add whole billionths (``floor(x * 1e9 + 0.5)``
as HUGEINT) and divide once at the end, as ``plume.functions.rsem.exact_sum``
does: integers add up to the same total in any order and on any number of
threads, so neither side depends on how its rows arrive.
"""

from __future__ import annotations


def R6(x: str) -> str:
    return f"floor(({x}) * 1e6 + 0.5) / 1e6"


def XA(x: str) -> str:
    """Mean of a double column by the sum described above."""
    return f"(CAST(sum(CAST(floor(({x}) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count({x}))"


DAILY = """
  SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n_events,
         coalesce((CAST(sum(CAST(floor((value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0) AS total_value, (CAST(sum(CAST(floor((value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(value)) AS mean_value,
         max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS error_flag
  FROM events GROUP BY 1, 2
"""

WEEKLY = f"""
  SELECT user_id, CAST(date_trunc('week', day) AS DATE) AS week_start, COUNT(*) AS n_days,
         CAST(sum(n_events) AS BIGINT) AS n_events, coalesce((CAST(sum(CAST(floor((total_value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0) AS total_value,
         (CAST(sum(CAST(floor((mean_value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(mean_value)) AS mean_daily_mean
  FROM ({DAILY}) d GROUP BY 1, 2
"""

USERS_DAYS = """
  users AS (SELECT DISTINCT user_id FROM events),
  days AS (SELECT CAST(t.d AS DATE) AS day
           FROM range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) t(d)),
  spine AS (SELECT user_id, day FROM users CROSS JOIN days)
"""

EVENT_TIME = """
  WITH b AS (
    SELECT *, ROW_NUMBER() OVER w AS rn,
           CASE WHEN {flag} = 1 AND lag({flag}) OVER w = 0 THEN ROW_NUMBER() OVER w END AS s,
           CASE WHEN {flag} = 1 AND lead({flag}) OVER w = 0 THEN ROW_NUMBER() OVER w END AS e
    FROM ({src}) x WINDOW w AS (PARTITION BY user_id ORDER BY {t})),
  f AS (
    SELECT *,
      coalesce(last_value(s IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY {t}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               first_value(s IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY {t}
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fs,
      coalesce(last_value(e IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY {t}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               first_value(e IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY {t}
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fe
    FROM b)
  SELECT *, rn - fs AS since_start, rn - fe AS since_end FROM f
"""

POLICY_DAILY = f"""
  WITH ev AS (SELECT *, CAST(ts AS DATE) AS day, user_id // 10 AS state_id FROM events),
  st AS (SELECT state_id,
           min(CASE WHEN event_type = 'signup' AND value > 150 THEN day END) AS ss,
           max(CASE WHEN event_type = 'error' AND value > 250 THEN day END) AS se
         FROM ev GROUP BY 1),
  co AS (SELECT user_id, min(state_id) AS state_id,
           min(CASE WHEN event_type = 'purchase' AND value > 150 THEN day END) AS cs,
           max(CASE WHEN event_type = 'click' AND value > 250 THEN day END) AS ce
         FROM ev GROUP BY 1),
  days AS (SELECT CAST(t.d AS DATE) AS day
           FROM range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) t(d)),
  sp AS (SELECT co.*, st.ss, st.se, days.day FROM co CROSS JOIN days
         LEFT JOIN st ON co.state_id = st.state_id),
  fl AS (SELECT user_id, day,
    CASE WHEN (ss IS NOT NULL AND ss <= day AND (se IS NULL OR se >= day))
           OR (ss IS NULL AND se IS NOT NULL AND se >= day) THEN 1 ELSE 0 END AS state_sip,
    CASE WHEN (cs IS NOT NULL AND cs <= day AND (ce IS NULL OR ce >= day))
           OR (cs IS NULL AND ce IS NOT NULL AND ce >= day) THEN 1 ELSE 0 END AS county_sip
    FROM sp)
  SELECT user_id, day, CAST(state_sip AS BIGINT) AS state_sip, CAST(county_sip AS BIGINT) AS county_sip,
         CAST(CASE WHEN state_sip = 1 OR county_sip = 1 THEN 1 ELSE 0 END AS BIGINT) AS sip_binary
  FROM fl
"""

WEEKLY_PANEL = f"""
  WITH wk AS ({WEEKLY}),
  er AS (SELECT user_id, CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE) AS week_start,
                COUNT(*) AS n_errors FROM events WHERE event_type = 'error' GROUP BY 1, 2),
  p AS (SELECT wk.*, coalesce(er.n_errors, 0) AS n_errors,
               CASE WHEN coalesce(er.n_errors, 0) >= 4 THEN 1 ELSE 0 END AS flag
        FROM wk LEFT JOIN er USING (user_id, week_start))
  {{rest}}
"""


DEVICE_ROWS = """
  WITH dv AS (
    SELECT lpad(CAST(user_id AS VARCHAR), 5, '0') AS county_fips, CAST(ts AS DATE) AS date,
           COUNT(*) AS devices, COUNT(CASE WHEN value < 10 THEN 1 END) AS home,
           (CAST(sum(CAST(floor((value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(value)) AS mh, max(value) AS mn, COUNT(*) + 2 AS cand
    FROM events GROUP BY user_id, event_type, CAST(ts AS DATE)),
  cov AS (SELECT county_fips FROM dv GROUP BY 1 HAVING count(DISTINCT date) = 30),
  rw AS (SELECT dv.* FROM dv JOIN cov USING (county_fips) WHERE substr(county_fips, 1, 2) <> '02'),
  ini AS (SELECT county_fips, avg(devices) AS init FROM rw
          WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-07' GROUP BY 1),
  r3 AS (SELECT rw.*, 1 - home / nullif(devices, 0) AS sod, 1 - home / nullif(cand, 0) AS socd,
           1 - (CASE WHEN home + init - devices < 0 THEN 0 ELSE home + init - devices END)
               / nullif(init, 0) AS saa
         FROM rw LEFT JOIN ini USING (county_fips)),
  daily AS (
    SELECT county_fips, date, CAST(coalesce(sum(devices), 0) AS BIGINT) AS device_count,
           CAST(coalesce(sum(home), 0) AS BIGINT) AS completely_home_device_count,
           (CAST(sum(CAST(floor((sod) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(sod)) AS share_of_devices, (CAST(sum(CAST(floor((socd) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(socd)) AS share_of_candidate_devices,
           (CAST(sum(CAST(floor((saa) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(saa)) AS share_adj_attrition,
           CASE WHEN count(devices * mh) = count(*) THEN (CAST(sum(CAST(floor((devices * mh) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) END / nullif(sum(devices), 0) AS median_home_dwell_time,
           CASE WHEN count(devices * mn) = count(*) THEN (CAST(sum(CAST(floor((devices * mn) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) END / nullif(sum(devices), 0) AS median_non_home_dwell_time
    FROM r3 GROUP BY 1, 2)
"""


def _dist_out(t: str) -> str:
    return f"""
  SELECT county_fips, {t}, device_count, completely_home_device_count,
         device_count - completely_home_device_count AS devices_leaving_home,
         {R6('ln(1 + device_count - completely_home_device_count)')} AS log_devices_leaving_home,
         {R6('median_home_dwell_time')} AS median_home_dwell_time,
         {R6('ln(1 + median_home_dwell_time)')} AS log_median_home_dwell_time,
         {R6('median_non_home_dwell_time')} AS median_non_home_dwell_time,
         {R6('ln(1 + median_non_home_dwell_time)')} AS log_median_non_home_dwell_time,
         {R6('share_of_devices')} AS share_of_devices,
         {R6('share_of_candidate_devices')} AS share_of_candidate_devices,
         {R6('share_adj_attrition')} AS share_adj_attrition"""


PLACE_WEEKS = """
  WITH ev AS (
    SELECT user_id, CAST(ts AS DATE) AS day,
           CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE) AS week,
           CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                           WHEN 'signup' THEN 4 WHEN 'view' THEN 5 ELSE 0 END AS code,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events),
  pw AS (SELECT user_id, code, week, COUNT(*) AS visits, count(DISTINCT day) AS visitors,
                sum(k) AS sk FROM ev GROUP BY 1, 2, 3),
  sp AS (SELECT *, least(visitors, CASE WHEN sk % 5 = 0 THEN 0 WHEN sk % 2 = 0 THEN sk % 9
                                        ELSE 0 END) AS same
         FROM pw),
  lk AS (SELECT user_id, code, 'st' || CAST(user_id // 50 AS VARCHAR) AS state,
                'co' || CAST(user_id // 5 AS VARCHAR) AS county,
                CAST(code + 10 AS VARCHAR) AS naics FROM pw GROUP BY 1, 2)
"""


ORDER_DAYS = """
  WITH o AS (SELECT o_custkey, o_orderpriority, o_totalprice,
                    CAST(DATE '1998-01-26' + CAST(((datediff('day', DATE '1998-01-26', CAST(o_orderdate AS DATE)) % 126) + 126) % 126 AS INTEGER) AS DATE) AS od
             FROM orders),
  pc AS (SELECT o_custkey, min(CASE WHEN o_orderpriority = '2-HIGH' THEN od END) AS cs,
                max(CASE WHEN o_orderpriority = '5-LOW' THEN od END) AS ce FROM o GROUP BY 1),
  pn AS (SELECT c_nationkey,
                arg_max(od, CASE WHEN o_orderpriority = '1-URGENT' AND month(od) = 3 THEN o_totalprice END) AS ss,
                arg_max(od, CASE WHEN o_orderpriority = '1-URGENT' AND month(od) = 4 THEN o_totalprice END) AS se
         FROM o JOIN customer ON o_custkey = c_custkey GROUP BY 1),
  co AS (SELECT c_custkey, c_nationkey,
                CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 2 THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
                     ELSE CAST(c_nationkey AS VARCHAR) END ||
                CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
                     ELSE CAST(c_custkey AS VARCHAR) END AS county_fips,
                lower(n_name) AS state, lower(trim(c_name)) AS county, ss, se, cs, ce
         FROM customer JOIN nation ON c_nationkey = n_nationkey
         LEFT JOIN pc ON c_custkey = pc.o_custkey LEFT JOIN pn USING (c_nationkey)),
  dd AS (SELECT co.*, CAST(t.d AS DATE) AS date
         FROM co CROSS JOIN range(DATE '1998-01-26', DATE '1998-06-01', INTERVAL 1 DAY) t(d)),
  fl AS (SELECT county_fips, state, county, date, ss AS state_sip_start_date, se AS state_sip_end_date,
           cs AS county_sip_start_date, ce AS county_sip_end_date,
           CASE WHEN (ss IS NOT NULL AND ss <= date AND (se IS NULL OR se >= date))
                  OR (ss IS NULL AND se IS NOT NULL AND se >= date) THEN 1 ELSE 0 END AS state_sip,
           CASE WHEN (cs IS NOT NULL AND cs <= date AND (ce IS NULL OR ce >= date))
                  OR (cs IS NULL AND ce IS NOT NULL AND ce >= date) THEN 1 ELSE 0 END AS county_sip
         FROM dd)
"""


NATION_CASES = """
  WITH k AS (SELECT n_nationkey, n_name, r_name,
                    lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS fips
             FROM nation JOIN region ON n_regionkey = r_regionkey),
  pn AS (SELECT c_nationkey, COUNT(*) AS nc, CAST(floor((CAST(sum(CAST(floor((abs(c_acctbal)) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9)) AS BIGINT) AS pop,
                {cells} FROM customer GROUP BY 1),
  nk AS (SELECT * FROM k LEFT JOIN pn ON n_nationkey = c_nationkey),
  dy AS (SELECT c_nationkey, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n,
                COUNT(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS u
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
  cum AS (SELECT c_nationkey, date,
                 sum(n) OVER (PARTITION BY c_nationkey ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cases,
                 sum(u) OVER (PARTITION BY c_nationkey ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS deaths
          FROM dy),
  sp AS (SELECT fips AS county_fips, lower(r_name) AS state, lower(trim(n_name)) AS county,
                coalesce(pop, 0) AS popestimate2019,
                CASE WHEN nc IS NULL THEN NULL ELSE ({seniors}) / nullif(CAST(nc AS DOUBLE), 0) END AS share_over_65,
                coalesce(nc, 0) * 10.0 * 2.58999 AS km_sq, n_nationkey, CAST(t.d AS DATE) AS date
         FROM nk CROSS JOIN range(DATE '1998-01-26', DATE '1998-06-01', INTERVAL 1 DAY) t(d)),
  cd AS (SELECT sp.county_fips, sp.date, state, county, popestimate2019,
                coalesce(cum.cases, 0) AS cases, coalesce(cum.deaths, 0) AS deaths, share_over_65, km_sq
         FROM sp LEFT JOIN cum ON sp.n_nationkey = cum.c_nationkey AND sp.date = cum.date)
""".format(cells=", ".join(f"COUNT(CASE WHEN floor((c_acctbal - 5000) / 417.0) = {k - 1} THEN 1 END) AS s{k}"
                           for k in range(1, 13)),
           seniors=" + ".join(f"s{k}" for k in range(1, 13)))


def _panel_sql() -> str:
    cells = ", ".join(f"COUNT(CASE WHEN floor((c_acctbal - 5000) / 417.0) = {k - 1} THEN 1 END) AS s{k}"
                      for k in range(1, 13))
    seniors = " + ".join(f"s{k}" for k in range(1, 13))
    shares = ("asian / population AS share_asian, black / population AS share_black, "
              "white / population AS share_white, bachelors / population AS share_bachelors, "
              "current_undergrad / population AS share_undergrad, "
              "hhinc_100k / population AS share_hhinc_100k, poverty / population AS share_poverty, "
              "msta / nullif(tocc, 0) AS share_msta, services / nullif(tocc, 0) AS share_services, "
              "sales / nullif(tocc, 0) AS share_sales, resources / nullif(tocc, 0) AS share_resources, "
              "public_transit / nullif(tocc, 0) AS share_public_transit")
    return f"""
  WITH k AS (SELECT n_nationkey, n_name, r_name,
                    lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS fips
             FROM nation JOIN region ON n_regionkey = r_regionkey),
  cn AS (SELECT c.*, k.* FROM customer c JOIN k ON c.c_nationkey = k.n_nationkey),
  pcd AS (SELECT o_custkey, CAST(DATE '1998-01-26' + CAST(((datediff('day', DATE '1998-01-26', CAST(o_orderdate AS DATE)) % 126) + 126) % 126 AS INTEGER) AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1, 2),
  dv0 AS (SELECT cn.fips AS county_fips, CAST(t.d AS DATE) AS date, cn.c_custkey, cn.c_acctbal
          FROM cn CROSS JOIN range(DATE '1998-01-25', DATE '1998-06-01', INTERVAL 1 DAY) t(d)),
  dv AS (SELECT county_fips, date, 50 + coalesce(n, 0) * 10 + (dayofweek(date) + 1) AS devices,
                20 + floor(abs(c_acctbal) / 2000) + CASE WHEN dayofmonth(date) > 15 THEN 1 ELSE 0 END AS home,
                abs(c_acctbal) / 10 + coalesce(n, 0) AS mh,
                abs(c_acctbal) / 20 + (dayofweek(date) + 1) AS mn,
                60 + coalesce(n, 0) * 10 + (dayofweek(date) + 1) AS cand
         FROM dv0 LEFT JOIN pcd ON dv0.c_custkey = pcd.o_custkey AND dv0.date = pcd.day),
  cov AS (SELECT county_fips FROM dv GROUP BY 1 HAVING count(DISTINCT date) = 127),
  rw AS (SELECT dv.* FROM dv JOIN cov USING (county_fips) WHERE substr(county_fips, 1, 2) <> '02'),
  ini AS (SELECT county_fips, avg(devices) AS init FROM rw
          WHERE date BETWEEN DATE '1998-01-26' AND DATE '1998-02-01' GROUP BY 1),
  r3 AS (SELECT rw.*, 1 - home / nullif(devices, 0) AS sod, 1 - home / nullif(cand, 0) AS socd,
           1 - (CASE WHEN home + init - devices < 0 THEN 0 ELSE home + init - devices END) / nullif(init, 0) AS saa
         FROM rw LEFT JOIN ini USING (county_fips)),
  dd AS (SELECT county_fips, date, coalesce(sum(devices), 0) AS device_count,
                coalesce(sum(home), 0) AS chdc, (CAST(sum(CAST(floor((sod) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(sod)) AS sod, (CAST(sum(CAST(floor((socd) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(socd)) AS socd, (CAST(sum(CAST(floor((saa) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(saa)) AS saa,
                CASE WHEN count(devices * mh) = count(*) THEN (CAST(sum(CAST(floor((devices * mh) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) END / nullif(sum(devices), 0) AS mh,
                CASE WHEN count(devices * mn) = count(*) THEN (CAST(sum(CAST(floor((devices * mn) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) END / nullif(sum(devices), 0) AS mn
         FROM r3 GROUP BY 1, 2),
  dist AS (SELECT county_fips, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
                  coalesce(sum(device_count), 0) AS device_count,
                  coalesce(sum(chdc), 0) AS completely_home_device_count,
                  (CAST(sum(CAST(floor((sod) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(sod)) AS share_of_devices, (CAST(sum(CAST(floor((socd) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(socd)) AS share_of_candidate_devices,
                  (CAST(sum(CAST(floor((saa) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(saa)) AS share_adj_attrition,
                  coalesce((CAST(sum(CAST(floor((device_count * mh) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0) / nullif(sum(device_count), 0) AS median_home_dwell_time,
                  coalesce((CAST(sum(CAST(floor((device_count * mn) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0) / nullif(sum(device_count), 0) AS median_non_home_dwell_time
           FROM dd WHERE date <= DATE '1998-05-31' GROUP BY 1, 2
           HAVING CAST(date_trunc('week', date) AS DATE) >= DATE '1998-01-26'),
  pc AS (SELECT fips, n_name, r_name, CAST(COUNT(*) AS DOUBLE) AS population,
                count(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END) AS bachelors,
                count(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 END) AS white,
                count(CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 END) AS black,
                count(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 END) AS asian,
                count(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 END) AS current_undergrad,
                count(CASE WHEN c_acctbal < 0 THEN 1 END) AS poverty,
                count(CASE WHEN c_acctbal > 9000 THEN 1 END) AS hhinc_100k,
                count(CASE WHEN c_acctbal > 0 THEN 1 END) AS tocc,
                count(CASE WHEN c_acctbal > 5000 THEN 1 END) AS msta,
                count(CASE WHEN c_acctbal BETWEEN 0 AND 2000 THEN 1 END) AS services,
                count(CASE WHEN c_acctbal BETWEEN 2000 AND 4000 THEN 1 END) AS sales,
                count(CASE WHEN c_acctbal BETWEEN 4000 AND 5000 THEN 1 END) AS resources,
                count(CASE WHEN c_acctbal > 8000 THEN 1 END) AS public_transit
         FROM cn GROUP BY 1, 2, 3),
  census AS (SELECT fips AS county_fips, lower(trim(n_name)) AS county, lower(trim(r_name)) AS state,
                    {shares} FROM pc),
  lw AS (SELECT k.fips, CAST(DATE '1998-01-26' + CAST(((datediff('day', DATE '1998-01-26', CAST(l_shipdate AS DATE)) % 126) + 126) % 126 AS INTEGER) AS DATE) AS day, l_discount, l_tax, l_quantity
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN k ON c_nationkey = n_nationkey),
  wd AS (SELECT fips, day, (CAST(sum(CAST(floor((l_discount) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(l_discount)) * 100 AS precip, min(l_tax) * 100 AS tmin,
                max(l_quantity) AS tmax FROM lw GROUP BY 1, 2),
  weather AS (SELECT fips AS county_fips, CAST(date_trunc('week', day) AS DATE) AS week_start_date,
                     (CAST(sum(CAST(floor((precip) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(precip)) AS mean_precip, (CAST(sum(CAST(floor((tmin) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(tmin)) AS mean_tmin, (CAST(sum(CAST(floor((tmax) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(tmax)) AS mean_tmax
              FROM wd WHERE CAST(date_trunc('week', day) AS DATE) >= DATE '1998-01-26' GROUP BY 1, 2),
  ou AS (SELECT k.fips, k.r_name, o_orderpriority, o_totalprice, CAST(DATE '1998-01-26' + CAST(((datediff('day', DATE '1998-01-26', CAST(o_orderdate AS DATE)) % 126) + 126) % 126 AS INTEGER) AS DATE) AS od
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN k ON c_nationkey = n_nationkey),
  rg AS (SELECT r_name, arg_max(od, CASE WHEN o_orderpriority = '1-URGENT' AND month(od) = 3 THEN o_totalprice END) AS ss,
                arg_max(od, CASE WHEN o_orderpriority = '1-URGENT' AND month(od) = 4 THEN o_totalprice END) AS se FROM ou GROUP BY 1),
  nt AS (SELECT fips, arg_max(od, CASE WHEN o_orderpriority = '1-URGENT' AND month(od) = 2 THEN o_totalprice END) AS cs,
                arg_max(od, CASE WHEN o_orderpriority = '1-URGENT' AND month(od) = 5 THEN o_totalprice END) AS ce FROM ou GROUP BY 1),
  ko AS (SELECT k.fips, lower(k.r_name) AS state, lower(trim(k.n_name)) AS county, ss, se, cs, ce
         FROM k LEFT JOIN rg USING (r_name) LEFT JOIN nt USING (fips)),
  od AS (SELECT ko.*, CAST(t.d AS DATE) AS date
         FROM ko CROSS JOIN range(DATE '1998-01-26', DATE '1998-06-01', INTERVAL 1 DAY) t(d)),
  ofl AS (SELECT *, CASE WHEN ((ss IS NOT NULL AND ss <= date AND (se IS NULL OR se >= date))
                          OR (ss IS NULL AND se IS NOT NULL AND se >= date))
                      OR ((cs IS NOT NULL AND cs <= date AND (ce IS NULL OR ce >= date))
                          OR (cs IS NULL AND ce IS NOT NULL AND ce >= date)) THEN 1 ELSE 0 END AS sip
          FROM od),
  ow AS (SELECT fips AS county_fips, state, county, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
                sum(sip) AS sip_days, CASE WHEN sum(sip) > 0 THEN 1 ELSE 0 END AS weekly_sipo_binary
         FROM ofl GROUP BY fips, state, county, date_trunc('week', date), ss, se, cs, ce),
  pn AS (SELECT c_nationkey, COUNT(*) AS nc, CAST(floor((CAST(sum(CAST(floor((abs(c_acctbal)) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9)) AS BIGINT) AS pop,
                {cells} FROM customer GROUP BY 1),
  nk AS (SELECT * FROM k LEFT JOIN pn ON n_nationkey = c_nationkey),
  dy AS (SELECT c_nationkey, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n,
                COUNT(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS u
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
  cum AS (SELECT c_nationkey, date,
                 sum(n) OVER (PARTITION BY c_nationkey ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cases,
                 sum(u) OVER (PARTITION BY c_nationkey ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS deaths
          FROM dy),
  csp AS (SELECT fips AS county_fips, lower(r_name) AS state, lower(trim(n_name)) AS county,
                 coalesce(pop, 0) AS pop, CASE WHEN nc IS NULL THEN NULL ELSE ({seniors}) / nullif(CAST(nc AS DOUBLE), 0) END AS share_over_65,
                 coalesce(nc, 0) * 10.0 * 2.58999 AS km_sq, n_nationkey, CAST(t.d AS DATE) AS date
          FROM nk CROSS JOIN range(DATE '1998-01-26', DATE '1998-06-01', INTERVAL 1 DAY) t(d)),
  ccd AS (SELECT csp.*, coalesce(cum.cases, 0) AS cases, coalesce(cum.deaths, 0) AS deaths
          FROM csp LEFT JOIN cum ON csp.n_nationkey = cum.c_nationkey AND csp.date = cum.date),
  cw AS (SELECT county_fips, state, county, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
                share_over_65, ln(1 + pop / nullif(km_sq, 0)) AS log_pop_density,
                ln(1 + avg(cases)) AS log_cases, ln(1 + avg(deaths)) AS log_deaths
         FROM ccd GROUP BY 1, 2, 3, 4, 5, 6),
  vt AS (SELECT fips AS county_fips, sum(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY')
                                            THEN floor(abs(c_acctbal)) END)
                                     / sum(floor(abs(c_acctbal))) AS trump_vote_share
         FROM cn GROUP BY 1),
  pan AS (SELECT census.state, census.county, dist.county_fips, dist.week_start_date,
                 dist.device_count, dist.completely_home_device_count,
                 dist.device_count - dist.completely_home_device_count AS devices_leaving_home,
                 ln(1 + dist.device_count - dist.completely_home_device_count) AS log_devices_leaving_home,
                 median_home_dwell_time, ln(1 + median_home_dwell_time) AS log_median_home_dwell_time,
                 median_non_home_dwell_time, ln(1 + median_non_home_dwell_time) AS log_median_non_home_dwell_time,
                 share_of_devices, share_of_candidate_devices, share_adj_attrition,
                 share_asian, share_black, share_white, share_bachelors, share_undergrad,
                 share_hhinc_100k, share_poverty, share_msta, share_services, share_sales,
                 share_resources, share_public_transit, mean_precip, mean_tmin, mean_tmax,
                 ow.sip_days, ow.weekly_sipo_binary, cw.share_over_65, cw.log_pop_density,
                 cw.log_cases, cw.log_deaths, vt.trump_vote_share
          FROM dist LEFT JOIN census ON dist.county_fips = census.county_fips
          LEFT JOIN weather ON dist.county_fips = weather.county_fips AND dist.week_start_date = weather.week_start_date
          LEFT JOIN ow ON dist.county_fips = ow.county_fips AND dist.week_start_date = ow.week_start_date
                      AND census.state = ow.state AND census.county = ow.county
          LEFT JOIN cw ON dist.county_fips = cw.county_fips AND dist.week_start_date = cw.week_start_date
                      AND census.state = cw.state AND census.county = cw.county
          LEFT JOIN vt ON dist.county_fips = vt.county_fips),
  sup AS (SELECT s_suppkey, lower(k.r_name) AS state, lower(k.n_name) AS county
          FROM supplier JOIN k ON s_nationkey = n_nationkey),
  ld AS (SELECT l_suppkey, day, CAST(date_trunc('week', day) AS DATE) AS week, l_quantity
         FROM (SELECT l_suppkey, l_quantity, CAST(DATE '1998-01-26' + CAST(((datediff('day', DATE '1998-01-26', CAST(l_shipdate AS DATE)) % 126) + 126) % 126 AS INTEGER) AS DATE) AS day FROM lineitem)),
  spw AS (SELECT l_suppkey, week, COUNT(*) AS visits, count(DISTINCT day) AS visitors,
                 CAST(sum(l_quantity) AS BIGINT) AS sq FROM ld GROUP BY 1, 2),
  sps AS (SELECT *, least(visitors, CASE WHEN sq % 5 = 0 THEN 0 WHEN sq % 2 = 0 THEN sq % 9
                                         ELSE 0 END) AS same FROM spw),
  poiw AS (SELECT state, county, week AS week_start_date, sum(visits) AS total_visits,
                  sum(visitors) AS total_visitors, sum(same) AS tsame, sum(visitors - same) AS tdiff
           FROM sps JOIN sup ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
  poi AS (SELECT poiw.state, poiw.county, kf.fips AS county_fips, week_start_date,
                 total_visits, ln(1 + total_visits) AS log_total_visits,
                 total_visitors, ln(1 + total_visitors) AS log_total_visitors,
                 tsame AS total_visitors_same_cbg, tsame / nullif(total_visitors, 0) AS share_visitors_same_cbg,
                 tdiff AS total_visitors_diff_cbg, tdiff / nullif(total_visitors, 0) AS share_visitors_diff_cbg
          FROM poiw LEFT JOIN (SELECT lower(r_name) AS state, lower(n_name) AS county, fips FROM k) kf
               ON poiw.state = kf.state AND poiw.county = kf.county),
  pan10 AS (SELECT poi.*, dist.device_count, dist.completely_home_device_count,
                 dist.device_count - dist.completely_home_device_count AS devices_leaving_home,
                 ln(1 + dist.device_count - dist.completely_home_device_count) AS log_devices_leaving_home,
                 median_home_dwell_time, ln(1 + median_home_dwell_time) AS log_median_home_dwell_time,
                 median_non_home_dwell_time, ln(1 + median_non_home_dwell_time) AS log_median_non_home_dwell_time,
                 share_of_devices, share_of_candidate_devices, share_adj_attrition,
                 share_asian, share_black, share_white, share_bachelors, share_undergrad,
                 share_hhinc_100k, share_poverty, share_msta, share_services, share_sales,
                 share_resources, share_public_transit, mean_precip, mean_tmin, mean_tmax,
                 ow.sip_days, ow.weekly_sipo_binary, cw.share_over_65, cw.log_pop_density,
                 cw.log_cases, cw.log_deaths, vt.trump_vote_share
          FROM poi LEFT JOIN dist ON poi.county_fips = dist.county_fips AND poi.week_start_date = dist.week_start_date
          LEFT JOIN census ON poi.county_fips = census.county_fips AND poi.state = census.state
                          AND poi.county = census.county
          LEFT JOIN weather ON poi.county_fips = weather.county_fips AND poi.week_start_date = weather.week_start_date
          LEFT JOIN ow ON poi.county_fips = ow.county_fips AND poi.week_start_date = ow.week_start_date
                      AND poi.state = ow.state AND poi.county = ow.county
          LEFT JOIN cw ON poi.county_fips = cw.county_fips AND poi.week_start_date = cw.week_start_date
                      AND poi.state = cw.state AND poi.county = cw.county
          LEFT JOIN vt ON poi.county_fips = vt.county_fips)
"""


def _event_time(src: str, flag: str, t: str) -> str:
    return EVENT_TIME.format(src=src, flag=flag, t=t)


def _profile_one(col: str) -> str:
    return f"""
  SELECT '{col}' AS "column", COUNT(*) AS n, {R6(f'min({col})')} AS min,
         {R6(f'quantile_cont({col}, 0.25)')} AS q1, {R6(f'quantile_cont({col}, 0.5)')} AS median,
         {R6(f'(CAST(sum(CAST(floor(({col}) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count({col}))')} AS mean, {R6(f'quantile_cont({col}, 0.75)')} AS q3,
         {R6(f'max({col})')} AS max, CAST(sum(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls,
         {R6(f'avg(CASE WHEN {col} IS NULL THEN 1.0 ELSE 0.0 END)')} AS null_share
  FROM po"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["daily_rollup"] = f"""
      SELECT user_id, day, n_events, {R6('total_value')} AS total_value,
             {R6('mean_value')} AS mean_value FROM ({DAILY}) d"""
    q["weekly_rollup"] = f"""
      SELECT user_id, week_start, n_days, n_events, {R6('total_value')} AS total_value,
             {R6('mean_daily_mean')} AS mean_daily_mean FROM ({WEEKLY}) w"""
    q["week_of_year_label"] = """
      SELECT day, CAST(floor((dayofyear(day) - 1) / 7) + 1 AS BIGINT) AS week_of_year,
             CAST(date_trunc('week', day) AS DATE) AS week_start, n_events
      FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n_events FROM events GROUP BY 1) x"""
    q["date_spine_fill"] = f"""
      WITH {USERS_DAYS}, d AS ({DAILY})
      SELECT spine.user_id, spine.day, CAST(coalesce(d.n_events, 0) AS BIGINT) AS n_events,
             {R6('coalesce(d.total_value, 0)')} AS total_value
      FROM spine LEFT JOIN d ON spine.user_id = d.user_id AND spine.day = d.day"""
    q["two_grain_counts"] = f"""
      WITH e AS (SELECT *, CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE) AS week_start FROM events)
      SELECT user_id, event_type, week_start, COUNT(*) AS n_events,
             {R6('coalesce((CAST(sum(CAST(floor((value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0)')} AS total_value FROM e GROUP BY 1, 2, 3
      UNION ALL
      SELECT user_id, CAST(NULL AS VARCHAR), week_start, COUNT(*) AS n_events,
             {R6('coalesce((CAST(sum(CAST(floor((value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0)')} AS total_value FROM e GROUP BY 1, 3"""
    q["weighted_mean_joinback"] = f"""
      WITH li AS (SELECT l_orderkey, l_quantity,
                         floor(l_quantity * l_discount * 100 + 0.5) AS cd,
                         floor(l_quantity * (CASE WHEN l_tax <> 0 THEN l_tax END) * 100 + 0.5) AS ct
                  FROM lineitem)
      SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS order_year,
             {R6('sum(l_quantity)')} AS total_qty,
             {R6('CAST(sum(cd) AS DOUBLE) / nullif(sum(l_quantity) * 100, 0)')} AS wmean_discount,
             {R6('CAST(CASE WHEN count(ct) = count(*) THEN sum(ct) END AS DOUBLE) / nullif(sum(l_quantity) * 100, 0)')} AS wmean_tax_strict,
             {R6('CAST(coalesce(sum(ct), 0) AS DOUBLE) / nullif(sum(l_quantity) * 100, 0)')} AS wmean_tax_skip
      FROM li JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""
    q["mean_of_ratios_vs_ratio_of_sums"] = f"""
      SELECT l_suppkey, {R6('(CAST(sum(CAST(floor((l_tax / nullif(l_discount, 0)) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(l_tax / nullif(l_discount, 0)))')} AS mean_of_ratios,
             {R6('(CAST(sum(CAST(floor((l_tax) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) / nullif((CAST(sum(CAST(floor((l_discount) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0)')} AS ratio_of_sums,
             {R6("sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) / nullif(sum(l_quantity), 0)")} AS share_returned
      FROM lineitem GROUP BY 1"""
    nv = "CASE WHEN event_type <> 'error' THEN value END"
    q["strict_sum_nulls"] = f"""
      SELECT user_id, CAST(ts AS DATE) AS day,
             {R6(f'CASE WHEN count({nv}) = count(*) THEN (CAST(sum(CAST(floor(({nv}) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) END')} AS strict_sum,
             COUNT(*) - COUNT({nv}) AS n_missing
      FROM events GROUP BY 1, 2"""
    q["skip_sum_nulls"] = f"""
      SELECT user_id, CAST(ts AS DATE) AS day, {R6(f'coalesce((CAST(sum(CAST(floor(({nv}) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0)')} AS skip_sum,
             {R6(f'(CAST(sum(CAST(floor(({nv}) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count({nv}))')} AS mean_skip
      FROM events GROUP BY 1, 2"""
    kk = "CASE WHEN event_type <> 'error' THEN event_type END"
    q["null_group"] = f"""
      SELECT {kk} AS k, COUNT(*) AS n_events, {R6('coalesce((CAST(sum(CAST(floor((value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0)')} AS total_value
      FROM events GROUP BY 1"""
    q["null_safe_left_join"] = f"""
      WITH e AS (SELECT event_id, {kk} AS k FROM events),
           pk AS (SELECT k, COUNT(*) AS k_events FROM e GROUP BY 1)
      SELECT e.event_id, e.k, pk.k_events FROM e LEFT JOIN pk ON e.k IS NOT DISTINCT FROM pk.k"""

    def pad(x, n):
        return (f"CASE WHEN length(CAST({x} AS VARCHAR)) < {n} "
                f"THEN lpad(CAST({x} AS VARCHAR), {n}, '0') ELSE CAST({x} AS VARCHAR) END")
    q["fips_pad_key"] = f"""
      WITH j AS (SELECT c_custkey, {pad('c_nationkey', 2)} || {pad('c_custkey', 3)} AS fips
                 FROM customer JOIN nation ON c_nationkey = n_nationkey)
      SELECT c_custkey, fips, substr(fips, 1, 2) AS state_code, substr(fips, 3) AS county_code,
             right(fips, 3) AS last3, TRY_CAST(fips AS BIGINT) AS key_num FROM j"""
    q["clean_names"] = """
      SELECT p_partkey, lower(trim(p_brand)) AS brand_lower, replace(p_brand, 'Brand#', '') AS brand_num,
             split_part(p_brand, '#', 1) AS brand_prefix,
             lower(trim(replace(p_type || ' County', ' County', ''))) AS type_clean,
             string_split_regex(p_name, '[^0-9A-Za-z]+')[1] AS name_1,
             string_split_regex(p_name, '[^0-9A-Za-z]+')[2] AS name_2
      FROM part"""
    ets = ["click", "error", "purchase", "signup", "view"]
    q["pivot_long_to_wide"] = "SELECT user_id, " + ", ".join(
        f"CAST(count(*) FILTER (WHERE event_type = '{t}') AS BIGINT) AS n_{t}" for t in ets) + \
        " FROM events GROUP BY 1"
    q["unpivot_wide_to_long"] = f"""
      WITH u AS (SELECT user_id, CAST(COUNT(*) AS DOUBLE) AS n_events, (CAST(sum(CAST(floor((value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) AS total_value,
                        max(value) AS max_value FROM events GROUP BY 1)
      SELECT user_id, 'n_events' AS measure, {R6('n_events')} AS value FROM u
      UNION ALL SELECT user_id, 'total_value', {R6('total_value')} FROM u
      UNION ALL SELECT user_id, 'max_value', {R6('max_value')} FROM u"""
    q["json_map_first"] = """
      WITH e AS (
        SELECT event_id, json_keys(props)[1] AS first_key,
               CAST(json_extract(props, '$."' || json_keys(props)[1] || '"') AS BIGINT) AS first_count,
               CASE WHEN event_type IN ('click', 'view') THEN 'k' ELSE 'z' END AS poi_key,
               CAST(floor(value) AS BIGINT) AS total FROM events),
      s AS (SELECT *, CASE WHEN first_key = poi_key THEN coalesce(first_count, 0)
                           WHEN first_key <> poi_key THEN 0 END AS same0 FROM e)
      SELECT event_id, first_key, first_count, least(total, same0) AS same_cbg,
             total - least(total, same0) AS diff_cbg FROM s"""
    q["array_explode_days"] = f"""
      WITH d AS ({DAILY}),
      w AS (SELECT DISTINCT user_id, CAST(date_trunc('week', day) AS DATE) AS week_start FROM d),
      x AS (SELECT user_id, CAST(week_start + INTERVAL (p) DAY AS DATE) AS day
            FROM w CROSS JOIN range(0, 7) r(p))
      SELECT x.user_id, x.day, CAST(coalesce(d.n_events, 0) AS BIGINT) AS visits
      FROM x LEFT JOIN d ON x.user_id = d.user_id AND x.day = d.day"""
    q["coverage_filter"] = f"""
      WITH d AS ({DAILY})
      SELECT user_id, day, n_events FROM d WHERE user_id IN (
        SELECT user_id FROM d GROUP BY 1
        HAVING count(DISTINCT day) = (SELECT count(DISTINCT day) FROM d))"""
    q["ever_treated_semi"] = f"""
      WITH d AS ({DAILY})
      SELECT user_id, day, n_events FROM d WHERE user_id IN (
        SELECT user_id FROM events GROUP BY 1
        HAVING max(CASE WHEN event_type = 'purchase' AND value > 200 THEN 1 ELSE 0 END) > 0)"""
    q["scalar_override"] = f"""
      SELECT c_custkey, c_nationkey, c_mktsegment, {R6('c_acctbal')} AS c_acctbal FROM customer
      WHERE NOT (c_nationkey = 3 AND c_mktsegment = 'BUILDING')
      UNION ALL
      SELECT -1, 3, 'BUILDING', {R6('(CAST(sum(CAST(floor((c_acctbal) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9)')} FROM customer
      WHERE c_nationkey = 3 AND c_mktsegment = 'BUILDING'
      HAVING count(*) > 0"""
    q["policy_interval_flag"] = POLICY_DAILY
    q["policy_weekly_days"] = f"""
      SELECT user_id, CAST(date_trunc('week', day) AS DATE) AS week_start_date,
             CAST(sum(sip_binary) AS BIGINT) AS sip_days,
             CAST(CASE WHEN sum(sip_binary) > 0 THEN 1 ELSE 0 END AS BIGINT) AS weekly_sipo_binary
      FROM ({POLICY_DAILY}) p GROUP BY 1, 2"""
    q["star_left_chain"] = f"""
      WITH li AS (SELECT l_orderkey, COUNT(*) AS n_lines,
                         (CAST(sum(CAST(floor((l_extendedprice * (1 - l_discount)) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) AS revenue
                  FROM lineitem GROUP BY 1)
      SELECT o.o_orderkey, c.c_name AS customer_name, n.n_name AS nation, r.r_name AS region,
             CAST(o.o_orderdate AS DATE) AS order_date, CAST(coalesce(li.n_lines, 0) AS BIGINT) AS n_lines,
             {R6('li.revenue')} AS revenue
      FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey
      LEFT JOIN customer c ON o.o_custkey = c.c_custkey
      LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
      LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""
    q["renamed_key_inner"] = """
      SELECT c_custkey, c_nationkey, n_name, n_regionkey
      FROM customer JOIN nation ON c_nationkey = n_nationkey"""
    rects = [("s1", "c1", 0.0, 0.0, 2000.0, 3000.0), ("s1", "c2", 2500.0, 1000.0, 5000.0, 6000.0),
             ("s2", "c3", 6000.0, 5000.0, 9000.0, 9000.0), ("s2", "c4", -1000.0, 2000.0, -100.0, 8000.0)]
    vals = ", ".join(f"('{s}', '{c}', {a}, {b}, {x}, {y})" for s, c, a, b, x, y in rects)
    q["point_in_rect"] = f"""
      WITH p AS (SELECT c_custkey, c_acctbal AS x, CAST(c_nationkey * 400 + c_custkey / 100 AS DOUBLE) AS y
                 FROM customer),
      r AS (SELECT * FROM (VALUES {vals}) t(state, county, x0, y0, x1, y1)),
      m AS (SELECT p.c_custkey, min(r.state || '|' || r.county) AS sc
            FROM p JOIN r ON p.x BETWEEN r.x0 AND r.x1 AND p.y BETWEEN r.y0 AND r.y1 GROUP BY 1)
      SELECT p.c_custkey, p.x, p.y, split_part(m.sc, '|', 1) AS state, split_part(m.sc, '|', 2) AS county
      FROM p LEFT JOIN m ON p.c_custkey = m.c_custkey"""
    polys = [("t1", "tri", [(0.0, 0.0), (3000.0, 0.0), (0.0, 3000.0)]),
             ("t1", "pent", [(4000.0, 1000.0), (6000.0, 1000.0), (7000.0, 3000.0), (5000.0, 5000.0),
                             (3500.0, 3000.0)]),
             ("t2", "quad", [(6000.0, 5000.0), (9500.0, 6000.0), (9000.0, 9000.0), (6500.0, 8500.0)])]
    edges = ", ".join(f"('{s_}', '{c}', {x1}, {y1}, {x2}, {y2})"
                      for s_, c, pts in polys
                      for (x1, y1), (x2, y2) in zip(pts, pts[1:] + pts[:1]))
    q["point_in_polygon"] = f"""
      WITH p AS (SELECT c_custkey, c_acctbal AS x, CAST(c_nationkey * 400 + c_custkey / 100 AS DOUBLE) AS y
                 FROM customer),
      e AS (SELECT * FROM (VALUES {edges}) t(state, county, x1, y1, x2, y2)),
      pe AS (SELECT p.c_custkey, e.state, e.county,
               CASE WHEN (x - x1) * (y2 - y1) = (y - y1) * (x2 - x1)
                     AND x BETWEEN least(x1, x2) AND greatest(x1, x2)
                     AND y BETWEEN least(y1, y2) AND greatest(y1, y2) THEN 1 ELSE 0 END AS on_edge,
               CASE WHEN (y1 > y) <> (y2 > y)
                     AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END AS crossing
             FROM p CROSS JOIN e),
      inside AS (SELECT c_custkey, min(state || '|' || county) AS sc FROM (
                   SELECT c_custkey, state, county FROM pe GROUP BY 1, 2, 3
                   HAVING max(on_edge) = 1 OR sum(crossing) % 2 = 1) z GROUP BY 1)
      SELECT p.c_custkey, p.x, p.y, split_part(inside.sc, '|', 1) AS state,
             split_part(inside.sc, '|', 2) AS county
      FROM p LEFT JOIN inside ON p.c_custkey = inside.c_custkey"""
    lagcols = ", ".join(
        [f"{R6(f'lag(total_value, {k}) OVER w')} AS lag{k}" for k in (1, 2, 3)] +
        [f"{R6(f'lead(total_value, {k}) OVER w')} AS lead{k}" for k in (1, 2, 3)])
    q["lags_leads"] = f"""
      SELECT user_id, week_start, {R6('total_value')} AS total_value, {lagcols}
      FROM ({WEEKLY}) x WINDOW w AS (PARTITION BY user_id ORDER BY week_start)"""
    sv = f"""WITH {USERS_DAYS}, d AS ({DAILY}),
      sv AS (SELECT spine.user_id, spine.day, d.mean_value AS v FROM spine
             LEFT JOIN d ON spine.user_id = d.user_id AND spine.day = d.day)"""
    down = ("last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    up = ("first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day "
          "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
    q["fill_down"] = f"{sv} SELECT user_id, day, {R6(down)} AS v_filled FROM sv"
    q["fill_up"] = f"{sv} SELECT user_id, day, {R6(up)} AS v_filled FROM sv"
    q["fill_both"] = f"{sv} SELECT user_id, day, {R6(f'coalesce({down}, {up})')} AS v_filled FROM sv"
    q["event_time"] = f"""
      SELECT user_id, day, CAST(error_flag AS BIGINT) AS error_flag, CAST(rn AS BIGINT) AS day_index,
             CAST(since_start AS BIGINT) AS since_start, CAST(since_end AS BIGINT) AS since_end
      FROM ({_event_time(DAILY, 'error_flag', 'day')}) z"""
    q["base_week_index"] = f"""
      SELECT user_id, week_start,
        {R6("total_value / nullif(last_value(CASE WHEN week_start = DATE '2024-01-01' THEN total_value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY week_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)")} AS value_index
      FROM ({WEEKLY}) w"""
    q["event_base_index"] = f"""
      WITH et AS ({_event_time(DAILY, 'error_flag', 'day')}),
      b AS (SELECT user_id, day, since_start, n_events,
              last_value(CASE WHEN since_start = -3 THEN n_events END IGNORE NULLS) OVER (
                PARTITION BY user_id ORDER BY since_start, day
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base
            FROM et WHERE since_start IS NOT NULL),
      x AS (SELECT *, n_events / nullif(base, 0) AS x_index FROM b),
      dd AS (SELECT user_id, day, ntile(10) OVER (ORDER BY x_index, user_id, day) AS decile
             FROM x WHERE x_index IS NOT NULL)
      SELECT x.user_id, x.day, CAST(x.since_start AS BIGINT) AS since_start,
             {R6('x.x_index')} AS x_index, CAST(dd.decile AS BIGINT) AS decile
      FROM x LEFT JOIN dd ON x.user_id = dd.user_id AND x.day = dd.day"""
    q["ntile_partitioned"] = """
      WITH o AS (SELECT o_orderkey, o_orderpriority,
                        CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders),
      r AS (SELECT o_orderkey, ntile(10) OVER (PARTITION BY o_orderpriority ORDER BY price, o_orderkey) AS decile
            FROM o WHERE price IS NOT NULL)
      SELECT o.o_orderkey, o.o_orderpriority, CAST(r.decile AS BIGINT) AS decile
      FROM o LEFT JOIN r ON o.o_orderkey = r.o_orderkey"""
    q["ntile_null_group"] = """
      WITH o AS (SELECT o_orderkey, o_totalprice,
                        CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END AS grp FROM orders),
      r AS (SELECT o_orderkey, ntile(10) OVER (PARTITION BY grp ORDER BY o_totalprice, o_orderkey) AS decile
            FROM o WHERE o_totalprice IS NOT NULL)
      SELECT o.o_orderkey, o.grp, CAST(r.decile AS BIGINT) AS decile
      FROM o LEFT JOIN r ON o.o_orderkey = r.o_orderkey"""
    q["ntile_global"] = """
      SELECT c_custkey, CAST(ntile(100) OVER (ORDER BY c_acctbal, c_custkey) AS BIGINT) AS pct
      FROM customer WHERE c_acctbal IS NOT NULL
      UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_acctbal IS NULL"""
    onehot = ", ".join(
        f"CAST(CASE WHEN decile = {i} THEN 1 WHEN decile <> {i} THEN 0 END AS BIGINT) AS decile_{i}"
        for i in range(1, 11))
    q["decile_one_hot"] = f"SELECT o_orderkey, decile, {onehot} FROM ({q['ntile_partitioned']}) z"
    qq = (f"{R6('quantile_cont(c_acctbal, 0.1)')} AS q10, {R6('quantile_cont(c_acctbal, 0.5)')} AS median, "
          f"{R6('quantile_cont(c_acctbal, 0.9)')} AS q90, "
          f"{R6('quantile_cont(c_acctbal, 0.9) - quantile_cont(c_acctbal, 0.1)')} AS gap_90_10")
    q["quantile_gap"] = f"""
      SELECT c_mktsegment, {qq} FROM customer GROUP BY 1
      UNION ALL SELECT CAST(NULL AS VARCHAR), {qq} FROM customer"""
    q["median_split_trend"] = f"""
      WITH med AS (SELECT quantile_cont(c_acctbal, 0.5) AS m FROM customer),
      cs AS (SELECT c_custkey, CAST(CASE WHEN c_acctbal > m THEN 1 ELSE 0 END AS BIGINT) AS above_median
             FROM customer, med),
      g AS (SELECT above_median, CAST(year(o_orderdate) AS BIGINT) AS order_year, (CAST(sum(CAST(floor((o_totalprice) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(o_totalprice)) AS mt
            FROM orders JOIN cs ON o_custkey = c_custkey GROUP BY 1, 2)
      SELECT above_median, order_year, {R6('mt')} AS mean_total,
        {R6('mt / nullif(max(CASE WHEN order_year = 1995 THEN mt END) OVER (PARTITION BY above_median), 0)')} AS mean_total_index
      FROM g"""
    q["attrition_share"] = f"""
      WITH r AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, COUNT(*) AS devices,
                        COUNT(CASE WHEN value < 10 THEN 1 END) AS home FROM events GROUP BY 1, 2, 3),
      i AS (SELECT user_id, avg(devices) AS init FROM r
            WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-07' GROUP BY 1),
      x AS (SELECT r.*, i.init,
              1 - (CASE WHEN home + init - devices < 0 THEN 0 ELSE home + init - devices END) / nullif(init, 0) AS sa,
              1 - home / nullif(devices, 0) AS sd
            FROM r LEFT JOIN i USING (user_id))
      SELECT user_id, day, {R6('(CAST(sum(CAST(floor((sa) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(sa))')} AS share_adj_attrition, {R6('(CAST(sum(CAST(floor((sd) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(sd))')} AS share_of_devices,
             CAST(sum(devices) - sum(home) AS BIGINT) AS devices_leaving_home
      FROM x GROUP BY 1, 2"""
    po = ("WITH po AS (SELECT o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey, "
          "CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS open_price FROM orders)")
    q["column_profile"] = po + " UNION ALL ".join(
        _profile_one(c) for c in ["o_totalprice", "o_custkey", "open_price"])
    q["log_transforms"] = f"""
      SELECT o_custkey, COUNT(*) AS n_orders, {R6('(CAST(sum(CAST(floor((o_totalprice) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(o_totalprice))')} AS mean_total,
             {R6('ln(1 + (CAST(sum(CAST(floor((o_totalprice) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(o_totalprice)))')} AS log_mean_total,
             {R6('(CAST(sum(CAST(floor((ln(1 + o_totalprice)) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(ln(1 + o_totalprice)))')} AS mean_log_total,
             {R6('exp((CAST(sum(CAST(floor((ln(1 + o_totalprice)) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(ln(1 + o_totalprice)))) - 1')} AS geo_mean_total
      FROM orders GROUP BY 1"""
    q["ols_pooled"] = f"""
      SELECT 'with_intercept' AS model, '(Intercept)' AS term,
             {R6('regr_intercept(l_extendedprice, l_quantity)')} AS estimate FROM lineitem
      UNION ALL SELECT 'with_intercept', 'l_quantity', {R6('regr_slope(l_extendedprice, l_quantity)')} FROM lineitem
      UNION ALL SELECT 'no_intercept', 'l_quantity',
             {R6('sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity)')} FROM lineitem"""
    dm = f"""
      WITH d AS ({DAILY}),
      dm AS (SELECT user_id, total_value - avg(total_value) OVER (PARTITION BY user_id) AS yd,
                    CAST(n_events AS DOUBLE) - avg(n_events) OVER (PARTITION BY user_id) AS xd FROM d),
      b AS (SELECT sum(xd * yd) / sum(xd * xd) AS beta, sum(xd * xd) AS sxx, COUNT(*) AS n,
                   count(DISTINCT user_id) AS g FROM dm)"""
    q["within_fe"] = f"""{dm}
      SELECT 'x' AS term, {R6('beta')} AS estimate, n AS n_obs, g AS n_groups FROM b"""
    q["cluster_se"] = f"""{dm},
      s AS (SELECT user_id, sum(xd * (yd - beta * xd)) AS sg FROM dm, b GROUP BY 1),
      v AS (SELECT sqrt((g / (g - 1.0)) * ((n - 1.0) / (n - 1.0)) * sum(sg * sg)) / sxx AS se
            FROM s, b GROUP BY g, n, sxx)
      SELECT 'x' AS term, {R6('beta')} AS estimate, {R6('se')} AS std_error,
             {R6('beta / se')} AS statistic, n AS n_obs, g AS n_clusters FROM b, v"""
    q["two_way_fe"] = f"""
      WITH {USERS_DAYS}, d AS ({DAILY}),
      bal AS (SELECT spine.user_id, spine.day, coalesce(d.total_value, 0) AS y,
                     CAST(coalesce(d.n_events, 0) AS DOUBLE) AS x
              FROM spine LEFT JOIN d ON spine.user_id = d.user_id AND spine.day = d.day),
      dd AS (SELECT y - avg(y) OVER (PARTITION BY user_id) - avg(y) OVER (PARTITION BY day) + avg(y) OVER () AS yd,
                    x - avg(x) OVER (PARTITION BY user_id) - avg(x) OVER (PARTITION BY day) + avg(x) OVER () AS xd
             FROM bal)
      SELECT 'x' AS term, {R6('sum(xd * yd) / sum(xd * xd)')} AS estimate FROM dd"""
    q["weekly_slope_sweep"] = f"""
      SELECT CAST(date_trunc('week', day) AS DATE) AS week_start,
             {R6('regr_slope(total_value, CAST(n_events AS DOUBLE))')} AS slope,
             {R6('regr_intercept(total_value, CAST(n_events AS DOUBLE))')} AS intercept,
             CAST(regr_count(total_value, CAST(n_events AS DOUBLE)) AS BIGINT) AS n_obs
      FROM ({DAILY}) d GROUP BY 1"""
    q["welch_ci"] = f"""
      WITH m AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year,
          count(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS n_a,
          avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS mean_a,
          var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS var_a,
          count(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS n_b,
          avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS mean_b,
          var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS var_b
        FROM orders GROUP BY 1)
      SELECT order_year, n_a, n_b, {R6('mean_a')} AS mean_a, {R6('mean_b')} AS mean_b,
             {R6('mean_a - mean_b')} AS diff, {R6('sqrt(var_a / n_a + var_b / n_b)')} AS se,
             {R6('(var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b) / nullif((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1), 0)')} AS df
      FROM m"""
    q["flagship_event_panel"] = WEEKLY_PANEL.format(rest=f"""
      , et AS ({_event_time('SELECT * FROM p', 'flag', 'week_start')})
      SELECT user_id, week_start, CAST(n_errors AS BIGINT) AS n_errors, CAST(flag AS BIGINT) AS flag,
             CAST(since_start AS BIGINT) AS weeks_since_start, CAST(since_end AS BIGINT) AS weeks_since_end,
             {R6('total_value')} AS total_value,
             {R6("total_value / nullif(last_value(CASE WHEN week_start = DATE '2024-01-01' THEN total_value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY week_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)")} AS value_index
      FROM et""")
    q["distancing_daily_build"] = DEVICE_ROWS + _dist_out("date") + " FROM daily"
    q["distancing_weekly_build"] = DEVICE_ROWS + """,
  wk AS (
    SELECT county_fips, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
           CAST(coalesce(sum(device_count), 0) AS BIGINT) AS device_count,
           CAST(coalesce(sum(completely_home_device_count), 0) AS BIGINT) AS completely_home_device_count,
           (CAST(sum(CAST(floor((share_of_devices) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(share_of_devices)) AS share_of_devices,
           (CAST(sum(CAST(floor((share_of_candidate_devices) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(share_of_candidate_devices)) AS share_of_candidate_devices,
           (CAST(sum(CAST(floor((share_adj_attrition) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(share_adj_attrition)) AS share_adj_attrition,
           coalesce((CAST(sum(CAST(floor((device_count * median_home_dwell_time) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0) / nullif(sum(device_count), 0) AS median_home_dwell_time,
           coalesce((CAST(sum(CAST(floor((device_count * median_non_home_dwell_time) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9), 0) / nullif(sum(device_count), 0) AS median_non_home_dwell_time
    FROM daily WHERE date <= DATE '2024-01-30' GROUP BY 1, 2)
""" + _dist_out("week_start_date") + " FROM wk WHERE week_start_date >= DATE '2024-01-01'"
    q["poi_weekly_build"] = PLACE_WEEKS + """
  SELECT state, county, week AS date_week_start, CAST(sum(visits) AS BIGINT) AS total_visits,
         CAST(sum(visitors) AS BIGINT) AS total_visitors,
         CAST(sum(same) AS BIGINT) AS total_visitors_same_cbg,
         CAST(sum(visitors - same) AS BIGINT) AS total_visitors_diff_cbg
  FROM sp JOIN lk USING (user_id, code) GROUP BY 1, 2, 3"""
    q["poi_weekly_naics_build"] = PLACE_WEEKS + """,
  own AS (SELECT *, least(visitors, CASE WHEN sk % 5 = 0 THEN 0 WHEN sk % 2 = 0 THEN sk % 9
                                         ELSE 2 END) AS found FROM pw)
  SELECT state, county, naics, week AS date_week_start, CAST(sum(visits) AS BIGINT) AS total_visits,
         CAST(sum(visitors) AS BIGINT) AS total_visitors,
         CAST(sum(found) AS BIGINT) AS total_visitors_same_cbg,
         CAST(sum(visitors - found) AS BIGINT) AS total_visitors_diff_cbg
  FROM own JOIN lk USING (user_id, code) GROUP BY 1, 2, 3, 4"""
    q["poi_daily_naics_build"] = PLACE_WEEKS + """,
  pd AS (SELECT pw.user_id, pw.code, CAST(pw.week + INTERVAL (r.i) DAY AS DATE) AS date
         FROM pw CROSS JOIN range(0, 7) r(i)),
  dn AS (SELECT user_id, code, day AS date, COUNT(*) AS n FROM ev GROUP BY 1, 2, 3)
  SELECT state, county, naics, pd.date, CAST(sum(coalesce(dn.n, 0)) AS BIGINT) AS total_visits
  FROM pd LEFT JOIN dn USING (user_id, code, date) JOIN lk USING (user_id, code)
  GROUP BY 1, 2, 3, 4"""
    q["poi_daily_build"] = f"""
      SELECT state, county, date, CAST(sum(total_visits) AS BIGINT) AS total_visits
      FROM ({q['poi_daily_naics_build']}) n GROUP BY 1, 2, 3"""
    q["orders_daily_build"] = ORDER_DAYS + """
  SELECT county_fips, state, county, date, state_sip_start_date, state_sip_end_date,
         county_sip_start_date, county_sip_end_date, CAST(state_sip AS BIGINT) AS state_sip,
         CAST(county_sip AS BIGINT) AS county_sip,
         CAST(CASE WHEN state_sip = 1 OR county_sip = 1 THEN 1 ELSE 0 END AS BIGINT) AS sip_binary
  FROM fl"""
    q["orders_weekly_build"] = ORDER_DAYS + """
  SELECT county_fips, state, county, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
         state_sip_start_date, county_sip_end_date,
         CAST(sum(CASE WHEN state_sip = 1 OR county_sip = 1 THEN 1 ELSE 0 END) AS BIGINT) AS sip_days,
         CAST(CASE WHEN sum(CASE WHEN state_sip = 1 OR county_sip = 1 THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS BIGINT) AS weekly_sipo_binary
  FROM fl GROUP BY county_fips, state, county, date_trunc('week', date), state_sip_start_date,
           state_sip_end_date, county_sip_start_date, county_sip_end_date"""
    q["cases_daily_build"] = NATION_CASES + f"""
  SELECT county_fips, date, state, county, popestimate2019, CAST(cases AS BIGINT) AS cases,
         CAST(deaths AS BIGINT) AS deaths, {R6('share_over_65')} AS share_over_65, {R6('km_sq')} AS km_sq,
         {R6('ln(1 + cases)')} AS log_cases, {R6('ln(1 + deaths)')} AS log_deaths,
         {R6('ln(1 + popestimate2019 / nullif(km_sq, 0))')} AS log_pop_density
  FROM cd"""
    q["cases_weekly_build"] = NATION_CASES + f"""
  , wk AS (SELECT county_fips, state, county, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
                  share_over_65, ln(1 + popestimate2019 / nullif(km_sq, 0)) AS lpd,
                  avg(cases) AS mc, avg(deaths) AS md
           FROM cd GROUP BY 1, 2, 3, 4, 5, 6)
  SELECT county_fips, state, county, week_start_date, {R6('share_over_65')} AS share_over_65,
         {R6('lpd')} AS log_pop_density, {R6('mc')} AS mean_cases, {R6('md')} AS mean_deaths,
         {R6('ln(1 + mc)')} AS log_cases, {R6('ln(1 + md)')} AS log_deaths
  FROM wk"""
    pan_doubles = ["log_devices_leaving_home", "median_home_dwell_time",
                   "log_median_home_dwell_time", "median_non_home_dwell_time",
                   "log_median_non_home_dwell_time", "share_of_devices", "share_of_candidate_devices",
                   "share_adj_attrition", "share_asian", "share_black", "share_white",
                   "share_bachelors", "share_undergrad", "share_hhinc_100k", "share_poverty",
                   "share_msta", "share_services", "share_sales", "share_resources",
                   "share_public_transit", "mean_precip", "mean_tmin", "mean_tmax",
                   "share_over_65", "log_pop_density", "log_cases", "log_deaths", "trump_vote_share"]
    pan_ints = ["device_count", "completely_home_device_count", "devices_leaving_home", "sip_days",
                "weekly_sipo_binary"]
    q["panel_distancing_build"] = _panel_sql() + f"""
  , f AS (SELECT * FROM pan WHERE trump_vote_share IS NOT NULL),
  r AS (SELECT county_fips, week_start_date,
               ntile(100) OVER (ORDER BY trump_vote_share, county_fips, week_start_date) AS nt FROM f)
  SELECT state, county, f.county_fips, f.week_start_date,
         {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in pan_ints)},
         {", ".join(f"{R6(c)} AS {c}" for c in pan_doubles)},
         CAST(CASE WHEN trump_vote_share >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS county_republican,
         CAST(r.nt AS BIGINT) AS republican_vtsh_ntile
  FROM f JOIN r ON f.county_fips = r.county_fips AND f.week_start_date = r.week_start_date"""
    q["streaming_device_rollup"] = f"""
      WITH dv AS (
        SELECT lpad(CAST(user_id AS VARCHAR), 5, '0') AS county_fips, CAST(ts AS DATE) AS date,
               COUNT(*) AS devices, COUNT(CASE WHEN value < 10 THEN 1 END) AS home,
               (CAST(sum(CAST(floor((value) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(value)) AS mh, max(value) AS mn, COUNT(*) + 2 AS cand
        FROM events GROUP BY user_id, event_type, CAST(ts AS DATE))
      SELECT county_fips, date, CAST(coalesce(sum(devices), 0) AS BIGINT) AS device_count,
             CAST(coalesce(sum(home), 0) AS BIGINT) AS completely_home_device_count,
             {R6('(CAST(sum(CAST(floor((1 - home / nullif(devices, 0)) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(1 - home / nullif(devices, 0)))')} AS share_of_devices,
             {R6('(CAST(sum(CAST(floor((1 - home / nullif(cand, 0)) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9 / count(1 - home / nullif(cand, 0)))')} AS share_of_candidate_devices,
             {R6('CASE WHEN count(devices * mh) = count(*) THEN (CAST(sum(CAST(floor((devices * mh) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) END / nullif(sum(devices), 0)')} AS median_home_dwell_time,
             {R6('CASE WHEN count(devices * mn) = count(*) THEN (CAST(sum(CAST(floor((devices * mn) * 1e9 + 5e-1) AS HUGEINT)) AS DOUBLE) / 1e9) END / nullif(sum(devices), 0)')} AS median_non_home_dwell_time
      FROM dv GROUP BY 1, 2"""
    poi_doubles = ["log_total_visits", "log_total_visitors", "share_visitors_same_cbg",
                   "share_visitors_diff_cbg"]
    poi_ints = ["total_visits", "total_visitors", "total_visitors_same_cbg", "total_visitors_diff_cbg"]
    q["panel_weekly_build"] = _panel_sql() + f"""
  , f AS (SELECT * FROM pan10 WHERE trump_vote_share IS NOT NULL),
  r AS (SELECT county_fips, week_start_date,
               ntile(100) OVER (ORDER BY trump_vote_share, county_fips, week_start_date) AS nt FROM f)
  SELECT state, county, f.county_fips, f.week_start_date,
         {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in poi_ints + pan_ints)},
         {", ".join(f"{R6(c)} AS {c}" for c in poi_doubles + pan_doubles)},
         CAST(CASE WHEN trump_vote_share >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS county_republican,
         CAST(r.nt AS BIGINT) AS republican_vtsh_ntile
  FROM f JOIN r ON f.county_fips = r.county_fips AND f.week_start_date = r.week_start_date"""
    f10 = _panel_sql() + "  , f AS (SELECT * FROM pan10 WHERE trump_vote_share IS NOT NULL)"
    q["map_deciles_report"] = f10 + f"""
  , eb AS (SELECT *, ROW_NUMBER() OVER w AS rn,
                  CASE WHEN weekly_sipo_binary = 1 AND lag(weekly_sipo_binary) OVER w = 0
                       THEN ROW_NUMBER() OVER w END AS s
           FROM f WINDOW w AS (PARTITION BY county_fips ORDER BY week_start_date)),
  ef AS (SELECT *, rn - coalesce(
            last_value(s IGNORE NULLS) OVER (PARTITION BY county_fips ORDER BY week_start_date
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value(s IGNORE NULLS) OVER (PARTITION BY county_fips ORDER BY week_start_date
                                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS wss
         FROM eb),
  eg AS (SELECT county_fips, state, week_start_date, wss, total_visits,
                last_value(CASE WHEN wss = -8 THEN total_visits END IGNORE NULLS) OVER (
                  PARTITION BY county_fips ORDER BY wss, week_start_date
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base
         FROM ef WHERE wss IS NOT NULL),
  ex AS (SELECT *, total_visits / nullif(base, 0) AS adj FROM eg),
  ed AS (SELECT county_fips, week_start_date,
                ntile(10) OVER (ORDER BY adj, county_fips, week_start_date) AS decile
         FROM ex WHERE adj IS NOT NULL)
  SELECT ex.county_fips, ex.state, ex.week_start_date, CAST(wss AS BIGINT) AS weeks_since_start,
         CAST(total_visits AS BIGINT) AS total_visits, {R6('adj')} AS adj_visits,
         CAST(decile AS BIGINT) AS decile
  FROM ex LEFT JOIN ed ON ex.county_fips = ed.county_fips AND ex.week_start_date = ed.week_start_date"""
    outs = ["total_visits", "total_visitors_diff_cbg", "devices_leaving_home",
            "median_non_home_dwell_time"]
    q["map_week_report"] = f"""
      SELECT county_fips AS region, decile AS value
      FROM ({q['map_deciles_report']}) m WHERE weeks_since_start = 0"""
    q["partisan_trends_report"] = f10 + """
  , med AS (SELECT quantile_cont(trump_vote_share, 0.5) AS m FROM f),
  g AS (SELECT CASE WHEN trump_vote_share > m THEN 1 WHEN trump_vote_share <= m THEN 0 END AS republican,
               week_start_date, """ + ", ".join(f"{XA(c)} AS {c}" for c in outs) + """
        FROM f, med GROUP BY 1, 2)
  SELECT CAST(republican AS BIGINT) AS republican, week_start_date, """ + ", ".join(
        [f"{R6(c)} AS {c}" for c in outs] +
        [f"{R6(f'{c} / nullif(max(CASE WHEN week_start_date = DATE {chr(39)}1998-01-26{chr(39)} THEN {c} END) OVER (PARTITION BY republican), 0)')} AS {c}_adj"
         for c in outs]) + " FROM g"
    flag = ("CASE WHEN ({a} IS NOT NULL AND {a} <= od.date AND ({b} IS NULL OR {b} >= od.date)) "
            "OR ({a} IS NULL AND {b} IS NOT NULL AND {b} >= od.date) THEN 1 ELSE 0 END")
    d_doubles = ["log_devices_leaving_home", "median_home_dwell_time", "log_median_home_dwell_time",
                 "median_non_home_dwell_time", "log_median_non_home_dwell_time", "share_of_devices",
                 "share_of_candidate_devices", "share_adj_attrition", "share_asian", "share_black",
                 "share_white", "share_bachelors", "share_undergrad", "share_hhinc_100k",
                 "share_poverty", "share_msta", "share_services", "share_sales", "share_resources",
                 "share_public_transit", "precip", "tmin", "tmax", "share_over_65", "km_sq",
                 "log_cases", "log_deaths", "log_pop_density", "trump_vote_share"]
    d_ints = ["device_count", "completely_home_device_count", "devices_leaving_home", "state_sip",
              "county_sip", "sip_binary", "popestimate2019", "cases", "deaths"]
    q["panel_daily_build"] = _panel_sql() + f"""
  , pd AS (SELECT census.state, census.county, dd.county_fips, dd.date, dd.device_count,
                  dd.chdc AS completely_home_device_count, dd.device_count - dd.chdc AS devices_leaving_home,
                  ln(1 + dd.device_count - dd.chdc) AS log_devices_leaving_home,
                  dd.mh AS median_home_dwell_time, ln(1 + dd.mh) AS log_median_home_dwell_time,
                  dd.mn AS median_non_home_dwell_time, ln(1 + dd.mn) AS log_median_non_home_dwell_time,
                  dd.sod AS share_of_devices, dd.socd AS share_of_candidate_devices,
                  dd.saa AS share_adj_attrition,
                  share_asian, share_black, share_white, share_bachelors, share_undergrad,
                  share_hhinc_100k, share_poverty, share_msta, share_services, share_sales,
                  share_resources, share_public_transit, wd.precip, wd.tmin, wd.tmax,
                  {flag.format(a='od.ss', b='od.se')} * (CASE WHEN od.fips IS NULL THEN NULL ELSE 1 END) AS state_sip,
                  {flag.format(a='od.cs', b='od.ce')} * (CASE WHEN od.fips IS NULL THEN NULL ELSE 1 END) AS county_sip,
                  ccd.pop AS popestimate2019, ccd.cases, ccd.deaths, ccd.share_over_65, ccd.km_sq,
                  ln(1 + ccd.cases) AS log_cases, ln(1 + ccd.deaths) AS log_deaths,
                  ln(1 + ccd.pop / nullif(ccd.km_sq, 0)) AS log_pop_density, vt.trump_vote_share
           FROM dd LEFT JOIN census ON dd.county_fips = census.county_fips
           LEFT JOIN wd ON dd.county_fips = wd.fips AND dd.date = wd.day
           LEFT JOIN od ON dd.county_fips = od.fips AND dd.date = od.date
                       AND census.state = od.state AND census.county = od.county
           LEFT JOIN ccd ON dd.county_fips = ccd.county_fips AND dd.date = ccd.date
                        AND census.state = ccd.state AND census.county = ccd.county
           LEFT JOIN vt ON dd.county_fips = vt.county_fips),
  pd2 AS (SELECT *, CASE WHEN state_sip = 1 OR county_sip = 1 THEN 1
                         WHEN state_sip IS NULL THEN NULL ELSE 0 END AS sip_binary FROM pd),
  f AS (SELECT * FROM pd2 WHERE trump_vote_share IS NOT NULL),
  r AS (SELECT county_fips, date,
               ntile(100) OVER (ORDER BY trump_vote_share, county_fips, date) AS nt FROM f)
  SELECT state, county, f.county_fips, f.date,
         {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in d_ints)},
         {", ".join(f"{R6(c)} AS {c}" for c in d_doubles)},
         CAST(CASE WHEN trump_vote_share >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS county_republican,
         CAST(r.nt AS BIGINT) AS republican_vtsh_ntile
  FROM f JOIN r ON f.county_fips = r.county_fips AND f.date = r.date"""
    q["votes_attributes_build"] = f"""
      WITH k AS (SELECT n_nationkey, n_name, r_name,
                        lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS fips
                 FROM nation JOIN region ON n_regionkey = r_regionkey)
      SELECT k.fips AS county_fips, k.r_name AS state, substr(k.fips, 1, 2) AS state_fips,
             k.n_name AS county_name, substr(k.fips, 1, 2) AS STATEFP10,
             {R6("sum(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN floor(abs(c_acctbal)) END) / sum(floor(abs(c_acctbal)))")} AS trump_vote_share
      FROM customer JOIN k ON c_nationkey = n_nationkey
      WHERE substr(k.fips, 1, 2) <> '02'
      GROUP BY k.fips, k.r_name, k.n_name"""
    q["state_order_dates_report"] = ORDER_DAYS + """
      SELECT DISTINCT county_fips, state_sip_start_date, state_sip_end_date, county_sip_start_date,
             county_sip_end_date FROM fl WHERE state = 'nation_3'"""
    q["snapshot_latest"] = """
      SELECT n_nationkey, n_name, n_regionkey, DATE '2024-01-31' AS snapshot_date FROM nation"""
    return q
