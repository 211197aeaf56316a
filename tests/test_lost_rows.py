"""Null and repeated keys keep their rows."""
from pyspark.sql import functions as F

from plume.operators import rank, spatial
from plume.sources import health


def test_ntile_and_quantiles_keep_the_null_group(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else f"g{i % 3}", float(i)) for i in range(30)],
                               "id int, g string, v double")
    out = rank.ntile(df, 2, "v", ["id"], ["g"])
    assert out.count() == 30
    assert out.filter("g is null").agg(F.max("ntile")).first()[0] == 2
    assert rank.quantiles(df, "v", [0.5], ["g"]).count() == 3


def test_every_point_row_stays(spark):
    square = [("s", "c", 0, k, x, y) for k, (x, y) in enumerate([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)])]
    points = spark.createDataFrame([(1, 1.1, 1.2), (1, 9.0, 9.0), (None, 2.1, 2.2), (None, 8.0, 2.0), (2, None, 1.0)],
                                   "id int, x double, y double")
    verts = spark.createDataFrame(square, "state string, county string, ring int, seq int, lon double, lat double")
    got = spatial.points_to_polygons(points, verts, "x", "y", ["id"], 1.0).collect()
    assert len(got) == 5
    assert sum(r["county"] == "c" for r in got) == 2


def test_patched_county_has_one_row(spark):
    area = spark.createDataFrame([("New York, NY", "36061", 10.0), ("Wayne, NY", "36117", 5.0), ("Washington, NY", "36115", 7.0)],
                                 "Areaname string, STCOU string, LND110200D double")
    for compat in (False, True):
        out = health.county_area(spark, area, compat=compat)
        assert out.count() == out.select("county_fips").distinct().count()


def test_unbalanced_two_way_is_exact(spark):
    import numpy as np

    from plume.stats.regress import two_way_within
    rng = np.random.default_rng(0)
    rows = [(e, e + k, float(rng.normal()), float(e % 3)) for e in range(30) for k in range(3)]
    rows = [(e, t, x, c, 2 * x + 0.3 * e - 0.2 * t + float(rng.normal()) * 0.1) for e, t, x, c in rows]
    fit = two_way_within(spark.createDataFrame(rows, "e int, t int, x double, c double, y double"),
                         "y", ["x", "c"], "e", "t")
    ents, times = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    a = np.array([[r[2]] + [float(r[0] == e) for e in ents] + [float(r[1] == t) for t in times[1:]] for r in rows])
    want = np.linalg.lstsq(a, np.array([r[4] for r in rows]), rcond=None)[0][0]
    assert list(fit.terms) == ["x"]
    assert abs(fit.coef[0] - want) < 1e-8
