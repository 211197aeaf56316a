"""DuckDB oracle SQL of the multi-regressor fits and of the t distribution.

A within fit is a Gram matrix of demeaned columns on which the sweep operator
is applied column by column in a recursive CTE: sweeping a column leaves the
residual norm of the next one on the diagonal, so collinear columns are seen
and skipped on the way, and the swept block ends as the inverse.
"""

from __future__ import annotations

from plume.plans.oracle import DAILY, R6, WEEKLY_PANEL, _event_time, _panel_sql


def two_sided_p(t: str, df: str, steps: int = 2000) -> str:
    """P(|T| > |t|): with t = sqrt(df) tan(a) the density is a power of the
    cosine, integrated by Simpson's rule from a to pi / 2."""
    a = f"atan(abs({t}) / sqrt({df}))"
    return f"""(2 * exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0)) / sqrt(pi())
      * (pi() / 2 - {a}) / {steps} / 3
      * list_sum([(CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                  * pow(greatest(cos({a} + i * (pi() / 2 - {a}) / {steps}), 0), {df} - 1)
                  FOR i IN range({steps} + 1)]))"""


def within_sql(panel: str, models: list[tuple[str, str, str, list[str]]], entity: str, order: str,
               band: float = 1.96) -> str:
    """Coefficient tables of (model, event column, outcome, controls) fits on
    the query ``panel`` (which may start with its own WITH)."""
    rows, names = [], []
    for m, ev, y, ctl in models:
        full = " AND ".join(f"{c} IS NOT NULL" for c in (ev, y, *ctl))
        rows.append(f"""SELECT '{m}' AS model, row_number() OVER (ORDER BY {entity}, {order}) AS r, {entity} AS g,
            {ev} AS ev, [{', '.join(f'CAST({c} AS DOUBLE)' for c in ctl)}]::DOUBLE[] AS ctl,
            CAST({y} AS DOUBLE) AS y FROM panel WHERE {full}""")
        names.append(f"SELECT '{m}' AS model, '{ev}' AS ev_name, [{', '.join(repr(c) for c in ctl)}]::VARCHAR[] AS ctl_names")
    return f"""
WITH RECURSIVE panel AS ({panel}),
  x AS ({' UNION ALL '.join(rows)}),
  names AS ({' UNION ALL '.join(names)}),
  lv AS (SELECT model, list(DISTINCT ev ORDER BY ev) AS levels, count(DISTINCT g) AS n_g, count(*) AS n
         FROM x GROUP BY model),
  shape AS (SELECT model, n, n_g, ev_name || levels[1] AS base,
                   list_concat([ev_name || e FOR e IN levels[2:]], ctl_names) AS terms
            FROM lv JOIN names USING (model)),
  vecs AS (SELECT model, r, g, list_concat(list_concat([(e = ev)::DOUBLE FOR e IN levels[2:]], ctl), [y]) AS v
           FROM x JOIN lv USING (model)),
  cells AS (SELECT model, r, g, unnest(range(1, len(v) + 1)) AS j, unnest(v) AS v FROM vecs),
  dm AS (SELECT *, v - avg(v) OVER (PARTITION BY model, g, j) AS d FROM cells),
  gram AS (SELECT a.model, a.j AS i, b.j, sum(a.d * b.d) AS s
           FROM dm a JOIN dm b ON a.model = b.model AND a.r = b.r GROUP BY ALL),
  lines AS (SELECT model, i, list(s ORDER BY j) AS line FROM gram GROUP BY model, i),
  mat AS (SELECT model, list(line ORDER BY i) AS m, count(*) AS w FROM lines GROUP BY model),
  raw AS (SELECT model, list(ss ORDER BY j) AS raw FROM (
            SELECT model, j, sum(v * v) AS ss FROM dm GROUP BY model, j) GROUP BY model),
  sweep AS (
    SELECT model, 1::BIGINT AS q, m, raw, w, []::BIGINT[] AS kept FROM mat JOIN raw USING (model)
    UNION ALL
    SELECT model, q + 1,
           CASE WHEN pr[q] > 1e-9 * raw[q] THEN
             [[CASE WHEN i = q AND j = q THEN 1 / pr[q] WHEN i = q THEN x / pr[q]
                    WHEN j = q THEN -x / pr[q] ELSE x - line[q] * pr[j] / pr[q] END
               FOR x, j IN line] FOR line, i IN m] ELSE m END,
           raw, w, CASE WHEN pr[q] > 1e-9 * raw[q] THEN list_append(kept, q) ELSE kept END
    FROM (SELECT *, m[q] AS pr FROM sweep WHERE q < w)),
  fit AS (SELECT * FROM sweep WHERE q = w),
  swept AS (SELECT model, kept, w, unnest(range(1, w + 1)) AS j, unnest(m) AS line FROM fit),
  coef AS (SELECT model, j, list_position(kept, j) AS term_order, line[w] AS beta, len(kept) AS k
           FROM swept WHERE list_contains(kept, j)),
  inv AS (SELECT model, j AS i, unnest(kept) AS j, unnest([line[a] FOR a IN kept]) AS v
          FROM swept WHERE list_contains(kept, j)),
  u AS (SELECT dm.model, r, g, sum(CASE WHEN dm.j = w THEN d ELSE -coalesce(beta, 0) * d END) AS u
        FROM dm JOIN fit ON fit.model = dm.model LEFT JOIN coef c ON c.model = dm.model AND c.j = dm.j
        GROUP BY ALL),
  score AS (SELECT dm.model, dm.g, dm.j, sum(d * u) AS s FROM dm JOIN u ON u.model = dm.model AND u.r = dm.r GROUP BY ALL),
  pull AS (SELECT inv.model, inv.i AS j, g, sum(v * s) AS p
           FROM inv JOIN score s ON s.model = inv.model AND s.j = inv.j GROUP BY ALL),
  spread AS (SELECT model, j, sum(p * p) AS pp FROM pull GROUP BY ALL),
  est AS (SELECT c.model, c.term_order, s.terms[c.j] AS term, beta,
                 sqrt((n_g / (n_g - 1.0)) * ((n - 1.0) / (n - k)) * pp) AS se, (n - n_g - k) AS df
          FROM coef c JOIN shape s ON s.model = c.model JOIN spread p ON p.model = c.model AND p.j = c.j),
  tab AS (SELECT model, term_order, term, beta, se, beta / se AS t, {two_sided_p('(beta / se)', 'df')} AS p,
                 CASE WHEN abs(beta / se) > 2.575829 THEN '***' WHEN abs(beta / se) > 1.959964 THEN '**'
                      WHEN abs(beta / se) > 1.644854 THEN '*' ELSE '' END AS stars FROM est
          UNION ALL SELECT model, 0, base, 0, 0, 0, 0, '' FROM shape)
SELECT model, CAST(term_order AS INTEGER) AS term_order, term, {R6('beta')} AS estimate, {R6('se')} AS std_error,
       {R6('t')} AS statistic, {R6('p')} AS p_value, stars, {R6('-beta')} AS percent_difference,
       {R6(f'-beta - {band} * se')} AS low, {R6(f'-beta + {band} * se')} AS high
FROM tab"""


_PANEL = WEEKLY_PANEL.format(rest=f"""
  , et AS ({_event_time('SELECT * FROM p', 'flag', 'week_start')}),
  lg AS (SELECT *, ln(1 + total_value) AS log_total_value, since_start AS weeks_since_start,
                since_end AS weeks_since_end FROM et)
  SELECT *, lag(log_total_value) OVER w AS lag1, lead(log_total_value) OVER w AS lead1
  FROM lg WINDOW w AS (PARTITION BY user_id ORDER BY week_start)""")


_DAYS = f"""
  SELECT user_id, day - DATE '2024-01-01' AS day_no, total_value AS y, CAST(n_events AS DOUBLE) AS x,
         sqrt(user_id + 0.5) AS z FROM ({DAILY}) d"""


_CONTROLS = ["share_asian", "share_black", "share_white", "share_bachelors", "share_undergrad",
             "share_hhinc_100k", "share_poverty", "share_msta", "share_services", "share_sales",
             "share_resources", "share_public_transit", "mean_precip", "mean_tmin", "mean_tmax",
             "weekly_sipo_binary", "share_over_65", "log_pop_density"]


def _report_sql() -> str:
    """The six event-study models on the weekly panel."""
    def since(mark: str) -> str:
        return f"""rn - coalesce(
            last_value({mark} IGNORE NULLS) OVER (PARTITION BY county_fips ORDER BY week_start_date
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value({mark} IGNORE NULLS) OVER (PARTITION BY county_fips ORDER BY week_start_date
                                                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

    def decile(col: str) -> str:
        return f"""CASE WHEN {col} IS NOT NULL THEN ntile(10) OVER (
            PARTITION BY week_start_date, {col} IS NULL ORDER BY {col}, county_fips) END"""

    flag = "weekly_sipo_binary"
    hots = [f"{c}_decile_{i}" for c in ("cases", "deaths") for i in range(1, 11)]
    panel = _panel_sql() + f"""
  , f AS (SELECT * FROM pan10 WHERE trump_vote_share IS NOT NULL AND county_fips IS NOT NULL
                                AND week_start_date IS NOT NULL),
  eb AS (SELECT *, row_number() OVER w AS rn,
                CASE WHEN {flag} = 1 AND lag({flag}) OVER w = 0 THEN row_number() OVER w END AS s,
                CASE WHEN {flag} = 1 AND lead({flag}) OVER w = 0 THEN row_number() OVER w END AS e,
                lag(log_total_visits) OVER w AS lag1, lag(log_total_visits, 2) OVER w AS lag2,
                lead(log_total_visits) OVER w AS lead1, lead(log_total_visits, 2) OVER w AS lead2
         FROM f WINDOW w AS (PARTITION BY county_fips ORDER BY week_start_date)),
  ef AS (SELECT *, {since('s')} AS weeks_since_start, {since('e')} AS weeks_since_end,
                {decile('log_cases')} AS cases_decile, {decile('log_deaths')} AS deaths_decile FROM eb)
  SELECT *, {', '.join(f"CAST({c}_decile = {i} AS DOUBLE) AS {c}_decile_{i}"
                       for c in ('cases', 'deaths') for i in range(1, 11))} FROM ef"""
    ctl = ["trump_vote_share", *_CONTROLS, *hots]
    return within_sql(panel, [
        (f"{side}_{kind}", f"weeks_since_{side}", "log_total_visits", cols) for side in ("start", "end")
        for kind, cols in (("plain", ctl[:1]), ("controls", ctl),
                           ("lags", [*ctl, "lag1", "lag2", "lead1", "lead2"]))],
        "county_fips", "week_start_date")


def fit_oracles() -> dict[str, str]:
    y = "log_total_value"
    plain = [(f"{side}_{kind}", f"weeks_since_{side}", y, ctl)
             for side in ("start", "end") for kind, ctl in (("plain", []), ("controls", ["n_days"]))]
    lags = [(f"{side}_lags", f"weeks_since_{side}", y, ["n_days", "lag1", "lead1"]) for side in ("start", "end")]
    return {"event_study_table": within_sql(_PANEL, plain, "user_id", "week_start"),
            "event_study_lags": within_sql(_PANEL, lags, "user_id", "week_start"),
            "event_study_report": _report_sql(),
            # entity effects swept, the days as the factor: the same slopes as two-way sweeping
            "two_way_fe_unbalanced": f"""
SELECT term, estimate, (SELECT count(*) FROM ({DAILY}) d) AS n_obs,
       (SELECT count(DISTINCT user_id) FROM events) AS n_groups
FROM ({within_sql(_DAYS, [("two_way", "day_no", "y", ["x", "z"])], "user_id", "day_no")}) t
WHERE term IN ('x', 'z')""",
            "welch_ci_bounds": f"""
WITH RECURSIVE m AS (
    SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year,
           avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') - avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS diff,
           var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'F') / count(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS va,
           var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'O') / count(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS vb,
           count(o_totalprice) FILTER (WHERE o_orderstatus = 'F') - 1 AS da,
           count(o_totalprice) FILTER (WHERE o_orderstatus = 'O') - 1 AS db
    FROM orders GROUP BY 1),
  w AS (SELECT order_year, diff, sqrt(va + vb) AS se, (va + vb) * (va + vb) / (va * va / da + vb * vb / db) AS df FROM m),
  halve AS (
    SELECT order_year, df, 0.0::DOUBLE AS lo, 1000.0::DOUBLE AS hi, 0 AS step FROM w WHERE df > 0
    UNION ALL
    SELECT order_year, df, CASE WHEN p > 0.05 THEN mid ELSE lo END, CASE WHEN p > 0.05 THEN hi ELSE mid END, step + 1
    FROM (SELECT *, (lo + hi) / 2 AS mid, {two_sided_p('((lo + hi) / 2)', 'df', 20_000)} AS p
          FROM halve WHERE step < 64))
SELECT w.order_year, {R6('diff')} AS diff, {R6('se')} AS se, {R6('diff - (lo + hi) / 2 * se')} AS ci_low,
       {R6('diff + (lo + hi) / 2 * se')} AS ci_high
FROM w LEFT JOIN halve h ON h.order_year = w.order_year AND step = 64"""}
