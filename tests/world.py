"""A small deterministic world in the reference's raw schemas (FIXTURES.md 1).

Counties: two in Alabama (one with a missing device day), New York and Kings
(merged into New York County), one in Alaska (dropped by the distancing
build) and Cook, Illinois.
"""

from __future__ import annotations

import datetime as dt
import json

from plume.sources import schemas as S

COUNTIES = [
    # fips, state, county name, maps name, lon0, lat0
    ("01001", "Alabama", "Autauga County", "autauga", -87.0, 32.0),
    ("01003", "Alabama", "Baldwin County", "baldwin", -86.0, 32.0),
    ("36061", "New York", "New York County", "new york", -74.0, 40.0),
    ("36047", "New York", "Kings County", "kings", -73.0, 40.0),
    ("02013", "Alaska", "Aleutians East Borough", "aleutians east", -160.0, 55.0),
    ("17031", "Illinois", "Cook County", "cook", -88.0, 41.0),
]
DAY0 = dt.date(2020, 1, 26)
N_DAYS = 128
WEEK0 = dt.date(2020, 1, 27)
N_WEEKS = 18
ORDERS = {  # fips -> (state start, state end, county start, county end) as M/D/YYYY text
    "01001": ("4/4/2020", "4/30/2020", None, None),
    "01003": ("4/4/2020", "4/30/2020", "3/20/2020", None),
    "36061": ("3/22/2020", None, "3/22/2020", None),
    "36047": ("3/22/2020", None, "3/22/2020", None),
    "02013": (None, None, None, None),
    "17031": ("3/21/2020", "5/29/2020", None, "4/30/2020"),
}
POP = {"01001": 55869, "01003": 223234, "36061": 1628706, "36047": 2559903, "02013": 3337,
       "17031": 5150233}


def _bg(fips, i):
    return f"{fips}{i:07d}"


def build(spark):
    t = {}
    # POI core + polygons (one square per county around lon0/lat0)
    core, verts, pats = [], [], []
    for n, (fips, st, cn, mname, lon, lat) in enumerate(COUNTIES):
        for i, (dx, dy) in enumerate([(0, 0), (1, 0), (1, 1), (0, 1)]):
            verts.append((st.lower(), mname, 1, i + 1, lon + dx, lat + dy))
        for p in range(2):
            pid = f"sg-{fips}-{p}"
            core.append((pid, f"{44 + p}1110", lon + 0.3 + 0.2 * p, lat + 0.5))
            for w in range(N_WEEKS):
                start = WEEK0 + dt.timedelta(days=7 * w)
                visits = [(n + p + d + w) % 9 + 1 for d in range(7)]
                poi_cbg = _bg(fips, p)
                homes = {poi_cbg: 3 + (w % 4), _bg(fips, 9): 2} if p == 0 else \
                    {_bg(fips, 8): 4, poi_cbg: 1}
                if w == 5:
                    homes = {}
                pats.append((pid, f"{start.isoformat()}T00:00:00-05:00", json.dumps(visits),
                              sum(visits), 6 + w % 3, poi_cbg, json.dumps(homes)))
    core.append(("sg-nowhere", "441110", 10.0, 10.0))  # outside every polygon
    t["poi_core"] = spark.createDataFrame(core, S.POI_CORE)
    t["county_polygons"] = spark.createDataFrame(verts, S.COUNTY_POLYGONS)
    t["weekly_patterns"] = spark.createDataFrame(pats, S.WEEKLY_PATTERNS)
    t["county_fips"] = spark.createDataFrame(
        [(st.lower(), m, f) for f, st, cn, m, _, _ in COUNTIES], S.COUNTY_FIPS)

    # device daily: 2 block groups per county, 128 days (01003 misses one day)
    dev = []
    for n, (fips, *_rest) in enumerate(COUNTIES):
        for d in range(N_DAYS):
            day = DAY0 + dt.timedelta(days=d)
            if fips == "01003" and d == 40:
                continue
            for b in range(2):
                devices = 100 + 10 * b + (d % 7) - (d // 30)
                home = 20 + (d % 5) + (15 if d > 55 else 0)
                dev.append((_bg(fips, b).lstrip("0"), f"{day.isoformat()}T00:00:00-06:00", devices,
                            home, 600.0 + d + b, 120.0 + b * 3 + n, devices + 5))
    t["device_daily"] = spark.createDataFrame(dev, S.DEVICE_DAILY)

    # cases (cumulative), NYC reported as "New York City" without FIPS
    cases = []
    for n, (fips, st, cn, *_r) in enumerate(COUNTIES):
        if fips == "36047":
            continue
        for d in range(40, 128):
            day = DAY0 + dt.timedelta(days=d)
            c = (d - 39) * (n + 1)
            if fips == "36061":
                cases.append((day, "New York City", st, None, c * 10, c))
            else:
                cases.append((day, cn.replace(" County", ""), st, fips, c, c // 10))
    t["cases_county"] = spark.createDataFrame(cases, S.CASES_COUNTY)
    t["county_area"] = spark.createDataFrame(
        [(f"{cn.replace(' County', '')}, {st[:2].upper()}", f, 500.0 + i * 100)
         for i, (f, st, cn, *_r) in enumerate(COUNTIES)] + [("Alabama", "01000", 50000.0)],
        S.COUNTY_AREA)
    t["county_population"] = spark.createDataFrame(
        [(f[:2], f[2:], st, cn, POP[f]) for f, st, cn, *_r in COUNTIES] +
        [("01", "000", "Alabama", "Alabama", 4903185)], S.COUNTY_POPULATION)
    acs = []
    for i, (f, st, cn, *_r) in enumerate(COUNTIES):
        name = f"{cn}, {st}"
        total = float(POP[f])
        vals = {"total": total, "bachelors": total * 0.2, "white": total * 0.6,
                "black": total * 0.2, "asian": total * 0.05, "current_undergrad": total * 0.04,
                "poverty": total * 0.12, "hhinc_100k": total * 0.03,
                "total_occupations": total * 0.5, "msta": total * 0.1, "services": total * 0.08,
                "sales": total * 0.12, "resources": total * 0.05, "public_transit": total * 0.01}
        for k in range(1, 13):
            vals[f"s{k}"] = total * 0.01 * (1 + (k + i) % 3)
        acs += [(f, name, k, v, 1.0) for k, v in vals.items()]
    t["acs_long"] = spark.createDataFrame(acs, S.ACS_LONG)
    t["county_pop_2016"] = spark.createDataFrame(
        [(f".{cn}, {st}", POP[f]) for f, st, cn, *_r in COUNTIES], S.COUNTY_POP_2016)
    t["county_orders"] = spark.createDataFrame(
        [(str(int(f[:2])), str(int(f[2:])), st[:2].upper(), st, cn, POP[f], *ORDERS[f],
          "c1", None, None, None, None) for f, st, cn, *_r in COUNTIES], S.COUNTY_ORDERS)
    t["weather_daily"] = spark.createDataFrame(
        [(str(int(f)), (DAY0 + dt.timedelta(days=d)).isoformat(), float(d % 4), 30.0 + d * 0.1,
          50.0 + d * 0.2) for f, *_r in COUNTIES for d in range(N_DAYS)], S.WEATHER_DAILY)
    votes = []
    for i, (f, st, cn, *_r) in enumerate(COUNTIES):
        for prec in range(2):
            votes.append((st, f[:2].lstrip("0"), st[:2].upper(), cn, f,
                          30.0, -80.0, "US President", "Donald Trump", "republican", "trump",
                          100 + 40 * i + prec))
            votes.append((st, f[:2].lstrip("0"), st[:2].upper(), cn, f, 30.0, -80.0,
                          "US President", "Hillary Clinton", "democratic", "clinton",
                          300 - 30 * i))
    t["precinct_votes"] = spark.createDataFrame(votes, S.PRECINCT_VOTES)
    t["county_attributes"] = spark.createDataFrame(
        [(f, f[:2]) for f, *_r in COUNTIES], S.COUNTY_ATTRIBUTES)
    return t
