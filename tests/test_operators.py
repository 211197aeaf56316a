"""Window, rank, reshape, spatial and policy operators on micro fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from plume.operators import policy, rank, shape, spatial, window


def _flags(spark, flags):
    return spark.createDataFrame([("a", i + 1, f) for i, f in enumerate(flags)],
                                 "e string, t int, f int")


def _et(spark, flags):
    out = window.event_time(_flags(spark, flags), "f", "e", "t", "s", "n")
    return [(r.s, r.n) for r in out.orderBy("t").collect()]


def test_event_time_one_spell(spark):
    got = _et(spark, [0, 0, 1, 1, 0, 0])
    assert [g[0] for g in got] == [-2, -1, 0, 1, 2, 3]
    assert [g[1] for g in got] == [-3, -2, -1, 0, 1, 2]


def test_event_time_two_spells_and_edges(spark):
    assert [g[0] for g in _et(spark, [0, 1, 0, 1, 0])] == [-1, 0, 1, 0, 1]
    got = _et(spark, [1, 1, 0])
    assert [g[0] for g in got] == [None, None, None] and [g[1] for g in got] == [-1, 0, 1]
    assert _et(spark, [0, 0, 0]) == [(None, None)] * 3


def test_fill_both(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([None, 2, None, 4, None])],
                               "e string, t int, v int")
    out = df.select("t", window.fill_both("v", "e", "t").alias("f")).orderBy("t").collect()
    assert [r.f for r in out] == [2, 2, 2, 4, 4]
    down = df.select("t", window.fill_down("v", "e", "t").alias("f")).orderBy("t").collect()
    assert [r.f for r in down] == [None, 2, 2, 4, 4]


def test_base_index_down_only(spark):
    df = spark.createDataFrame([("a", t, x) for t, x in zip([-2, -1, 0, 1], [8.0, 4.0, 2.0, 1.0])],
                               "e string, t int, x double")
    out = window.base_index(df, "x", "t", -1, "e").orderBy("t").collect()
    assert [r["index"] for r in out] == [None, 1.0, 0.5, 0.25]


def test_ntile_with_null(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 1.0), (3, None), (4, 3.0)], "k int, x double")
    out = rank.ntile(df, 10, "x", ["k"], out_col="d")
    assert {r.k: r.d for r in out.collect()} == {1: 3, 2: 1, 3: None, 4: 2}


def test_ntile_sizes_differ_by_at_most_one(spark):
    df = spark.range(0, 1003).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("x"))
    out = rank.ntile(df, 7, "x", ["k"], out_col="d")
    sizes = [r["count"] for r in out.groupBy("d").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 1003


def test_rank_is_partition_count_invariant(spark):
    df = spark.range(0, 500).select(F.col("id").alias("k"), ((F.col("id") * 37) % 101).alias("x"),
                                     (F.col("id") % 3).alias("g"))
    a = {r.k: r.rr for r in rank.dist_rank(df, ["x", "k"], ["g"], "rr", num_partitions=3).collect()}
    b = {r.k: r.rr for r in rank.dist_rank(df, ["x", "k"], ["g"], "rr", num_partitions=11).collect()}
    assert a == b and sorted(a.values())[:3] == [1, 1, 1]


def test_quantile_type7(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = rank.quantiles(df, "x", [0.1, 0.5, 0.9], names=["a", "b", "c"]).collect()[0]
    assert abs(r.a - 1.3) < 1e-12 and abs(r.b - 2.5) < 1e-12 and abs(r.c - 7.9) < 1e-12


def test_daily_array_explode(spark):
    df = spark.createDataFrame([("p", dt.date(2020, 1, 27), "[3,0,5,1,2,4,6]")],
                               "id string, start date, v string")
    out = shape.explode_daily_array(df, "v", "start", "date", "visits").orderBy("date").collect()
    assert out[0].date == dt.date(2020, 1, 27) and out[0].visits == 3
    assert out[-1].date == dt.date(2020, 2, 2) and out[-1].visits == 6 and len(out) == 7


def test_date_spine(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert shape.date_spine(keys, "2020-01-27", "2020-05-31").count() == 2 * 126


def test_cols_between_and_front(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert shape.cols_between(df, "b", "d") == ["b", "c", "d"]
    assert shape.front(df, "c").columns == ["c", "a", "b", "d"]
    assert shape.cols_slice(df, 2, 3) == ["b", "c"]


def test_one_hot_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "d int")
    out = shape.one_hot(df, "d", [1, 2]).collect()
    assert [(r.d_1, r.d_2) for r in out] == [(1, 0), (None, None)]


def test_order_flags(spark):
    D = lambda s: dt.date.fromisoformat(s)
    rows = [
        (D("2020-03-19"), D("2020-03-20"), None), (D("2020-03-20"), D("2020-03-20"), None),
        (D("2020-05-31"), D("2020-03-20"), None),
        (D("2020-03-24"), None, D("2020-03-25")), (D("2020-03-25"), None, D("2020-03-25")),
        (D("2020-03-26"), None, D("2020-03-25")),
        (D("2020-03-20"), D("2020-03-20"), D("2020-03-25")),
        (D("2020-03-25"), D("2020-03-20"), D("2020-03-25")),
        (D("2020-03-26"), D("2020-03-20"), D("2020-03-25")),
        (D("2020-04-01"), None, None),
    ]
    df = spark.createDataFrame(rows, "d date, s date, e date")
    got = [r.f for r in df.select(policy.in_force(F.col("d"), F.col("s"), F.col("e")).alias("f")).collect()]
    assert got == [0, 1, 1, 1, 1, 0, 1, 1, 0, 0]


def test_point_in_polygon_matches_brute_force(spark):
    verts = spark.createDataFrame(
        [("s", "tri", 1, 1, 0.0, 0.0), ("s", "tri", 1, 2, 4.0, 0.0), ("s", "tri", 1, 3, 0.0, 4.0),
         ("s", "sq", 1, 1, 5.0, 5.0), ("s", "sq", 1, 2, 7.0, 5.0), ("s", "sq", 1, 3, 7.0, 7.0),
         ("s", "sq", 1, 4, 5.0, 7.0)],
        "state string, county string, ring int, seq int, lon double, lat double")
    pts = spark.createDataFrame(
        [(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 2.0, 2.0), (4, 6.0, 6.0), (5, 7.0, 6.0), (6, 9.0, 9.0),
         (7, 0.0, 0.0)], "id int, x double, y double")
    out = spatial.points_to_polygons(pts, verts, "x", "y", ["id"], cell=1.5)
    got = {r.id: r.county for r in out.collect()}
    # (2,2) lies on the hypotenuse and (7,6) on the square's edge: both inside
    assert got == {1: "tri", 2: None, 3: "tri", 4: "sq", 5: "sq", 6: None, 7: "tri"}


def test_full_coverage_drops_partial_entities(spark):
    from plume.operators.aggregate import coverage_keys, full_coverage
    rows = [("a", d) for d in range(3)] + [("b", 0), ("b", 2)] + [("c", d) for d in range(3)]
    df = spark.createDataFrame(rows, "e string, d int")
    assert sorted({r.e for r in full_coverage(df, ["e"], "d", 3).collect()}) == ["a", "c"]
    assert sorted(r.e for r in coverage_keys(df, ["e"], "d").collect()) == ["a", "c"]
