"""Interval joins, inferred and checked scans, versions, one-parse outputs, key ranks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from plume.operators import intervals, rank
from plume.plans import standins
from plume.sources import infer, io, mobility

DAY = dt.date(2020, 1, 1)


def _day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


@pytest.mark.parametrize("lo, hi", [(0, 0), (0, 1), (5, 5), (3, 17), (0, 63), (1, 62)])
def test_pieces_cover_an_interval_once(spark, lo, hi):
    row = spark.range(1).select(intervals.pieces(F.lit(lo).cast("bigint"), F.lit(hi).cast("bigint"), 6).alias("p")).first()
    covered = [x for level, n in row["p"] for x in range(n << level, (n + 1) << level)]
    assert sorted(covered) == list(range(lo, hi + 1)) and len(row["p"]) <= 14


def test_range_join_against_between(spark):
    spans = [("a", 1, 4, 10), ("a", 2, 8, 8), ("a", 3, None, 6), ("a", 4, 9, None), ("a", 5, None, None), ("a", 6, 9, 3),
             ("b", 7, -50, 400), (None, 8, 2, 5), ("a", 9, 4, 10), ("b", 10, 300, 500)]
    points = [("a", n, i) for i, n in enumerate([0, 3, 4, 4, 6, 8, 9, 10, 30])] + [("b", 7, 20), (None, 3, 21), ("a", None, 22), ("c", 4, 23)]
    iv = spark.createDataFrame([(k, i, _day(a), _day(b)) for k, i, a, b in spans], "k string, span int, a date, b date")
    pt = spark.createDataFrame([(k, _day(n), i) for k, n, i in points], "k string, d date, id int")
    want = sorted((i, s) for k, n, i in points for q, s, a, b in spans
                  if n is not None and k == q and (a is not None or b is not None)
                  and (a is None or a <= n) and (b is None or n <= b))
    got = intervals.range_join(pt, iv, "d", "a", "b", ["k"])
    assert sorted((r["id"], r["span"]) for r in got.collect()) == want
    count = intervals.times_in_force(pt, iv, "d", "a", "b", ["k"])
    assert sorted((r["id"], r["in_force"]) for r in count.collect()) == sorted(
        (i, sum(x == i for x, _ in want)) for _, _, i in points)
    free = intervals.range_join(pt.drop("k"), iv.drop("k"), "d", "a", "b").count()
    assert free == sum(n is not None and (a is not None or b is not None) and (a is None or a <= n) and (b is None or n <= b)
                       for _, n, _ in points for _, _, a, b in spans)
    assert intervals.range_join(pt.filter("false"), iv, "d", "a", "b", ["k"]).count() == 0
    assert intervals.range_join(pt, iv.filter("false"), "d", "a", "b", ["k"]).count() == 0


def test_range_join_is_an_equi_join(spark):
    iv = spark.createDataFrame([(_day(1), _day(5))], "a date, b date")
    pt = spark.createDataFrame([(_day(n),) for n in range(9)], "d date")
    plan = intervals.range_join(pt, iv, "d", "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_types_are_the_narrowest_that_fit_all_values(spark, tmp_path):
    with open(tmp_path / "x.csv", "w") as f:
        f.write("code,n,x,day,at,flag,mixed,none,big,neg\n"
                "01001,5,1.5,2020-01-02,2020-01-02 03:04:05,TRUE,7,NA,9223372036854775807,-3\n"
                "01003,NA,2,2020-12-31,2020-01-02,F,7.5,,9223372036854775808, +4\n"
                "99999,0,1e3,NA,,T,x,NA,1,0\n")
    df = infer.read_inferred(spark, str(tmp_path))
    assert dict(df.dtypes) == {"code": "string", "n": "bigint", "x": "double", "day": "date", "at": "timestamp",
                               "flag": "boolean", "mixed": "string", "none": "string", "big": "double", "neg": "bigint"}
    rows = df.orderBy("code").collect()
    assert [r["code"] for r in rows] == ["01001", "01003", "99999"]
    assert [r["n"] for r in rows] == [5, None, 0] and rows[1]["neg"] == 4 and rows[2]["x"] == 1000.0
    assert rows[1]["flag"] is False and rows[2]["day"] is None
    fixed = infer.read_inferred(spark, str(tmp_path), types={"n": "string"})
    assert dict(fixed.dtypes)["n"] == "string"


def test_one_value_among_many_files_widens_the_type(spark, tmp_path):
    spark.range(2000).select(F.when(F.col("id") == 1234, "007").otherwise(F.col("id").cast("string")).alias("v")) \
        .repartition(7).write.option("header", True).csv(str(tmp_path / "many"))
    assert infer.infer_types(spark.read.option("header", True).csv(str(tmp_path / "many"))) == {"v": "string"}


def test_rejected_lines_are_kept_with_their_file(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    for name, lines in (("a.csv", ["1,2.5", "x,1", "2,", "3,4,5"]), ("b.csv", ["4,oops", "5,6"])):
        with open(tmp_path / "in" / name, "w") as f:
            f.write("\n".join(lines) + "\n")
    checked = io.read_csv_checked(spark, str(tmp_path / "in"), "k bigint, v double")
    good, rejects, counts = io.split_rejects(checked, str(tmp_path / "out"))
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 2.5), (2, None), (5, 6.0)]
    assert sorted(map(tuple, rejects.collect())) == [("3,4,5", "a.csv"), ("4,oops", "b.csv"), ("x,1", "a.csv")]
    assert counts == {"rows": 6, "rejected": 3}


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    base = str(tmp_path / "snap")
    with pytest.raises(FileNotFoundError):
        io.read_latest(spark, base)
    rows = spark.range(100).withColumn("v", F.lit("old"))
    io.write_snapshot(rows, base, "2020-06-04")
    broken = spark.range(100, numPartitions=4).withColumn(
        "v", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="lost"):
        io.write_snapshot(broken, base, "2020-06-05")
    assert {r["v"] for r in io.read_latest(spark, base).collect()} == {"old"}
    with pytest.raises(FileNotFoundError):
        io.read_snapshot(spark, base, "2020-06-05")
    held = io.read_latest(spark, base)
    io.write_snapshot(rows.withColumn("v", F.lit("newer")), base, "2020-06-04")
    assert {r["v"] for r in held.collect()} == {"old"}  # a reader keeps its version
    assert {r["v"] for r in io.read_snapshot(spark, base, "2020-06-04").collect()} == {"newer"}


def test_four_outputs_from_one_scan(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    standins.weekly_patterns(spark, d).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = raw.mapInArrow(count, raw.schema)
    poi = standins.poi_lookup(spark, d)
    io.write_stacked(mobility.poi_patterns_stacked(counted, poi), str(tmp_path / "out"))
    assert seen.value == raw.count()
    want = mobility.poi_patterns(raw, poi)
    for name in ("weekly", "weekly_naics", "daily", "daily_naics"):
        cols = [c for c in want[name].columns]
        got = io.read_stacked(spark, str(tmp_path / "out"), name,
                              ["date" if c == "date_week_start" else c for c in cols]).toDF(*cols)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want[name].collect()), key=str)


def test_ntile_ranks_keys_only(spark):
    rows = [(i % 3, float(i % 7) if i % 5 else None, i, "x" * 2000) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, v double, id int, wide string")
    keys = rank.key_ranks(df.filter("v is not null"), "v", ["id"], ["g"])
    assert set(keys.columns) == {"g", "v", "id", "_n", "_first", "_sz"}
    got = {r["id"]: r["q"] for r in rank.ntile(df, 4, "v", ["id"], ["g"], "q").collect()}
    spark.createDataFrame(rows, "g int, v double, id int, wide string").createOrReplaceTempView("ntile_rows")
    want = {r["id"]: r["q"] for r in spark.sql(
        "select id, case when v is not null then ntile(4) over (partition by g, v is null order by v, id) end q from ntile_rows").collect()}
    assert got == want


def test_ntile_of_rows_alike_in_all_keys(spark):
    df = spark.createDataFrame([(1.0, 1)] * 5 + [(2.0, 2)] * 3 + [(None, 3)], "v double, id int")
    got = sorted([(r["v"], r["q"]) for r in rank.ntile(df, 4, "v", ["id"], out_col="q").collect()], key=str)
    assert got == sorted([(1.0, 1), (1.0, 1), (1.0, 2), (1.0, 2), (1.0, 3), (2.0, 3), (2.0, 4), (2.0, 4), (None, None)], key=str)
